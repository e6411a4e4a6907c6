"""Raw (bronze) CSV ingest: every cell is text, spreadsheet null tokens become null, each row
gets a landing-order key for keep-first rules, and lines with too many or too few cells are
kept for an audit."""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text a spreadsheet export uses for a missing cell. Matched exactly,
# without trimming.
DEFAULT_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                       "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                       "nan", "null"]


class MissingSourceError(FileNotFoundError):
    pass


def normalise_nulls(df: DataFrame, tokens: list[str] | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """Replace null tokens by null in text columns (exact match)."""
    toks = DEFAULT_NULL_TOKENS if tokens is None else tokens
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[
        (F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
         if c in cols else F.col(c)) for c in df.columns])


def landing_order() -> Column:
    """A total order of rows that follows file order: (file, split start, position).

    ``monotonically_increasing_id`` grows within a task's input split, and a split is a
    contiguous byte range of one file, so ordering by (path, split start, id) is file
    order. It is recomputed identically on a retry (same splits, same positions).
    """
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"))


def source_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files (path, bytes) under a file, folder or glob; names that begin with ``_`` or ``.`` are
    not data. A path that does not exist gives no files."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath) if any(ch in path for ch in "*?[") else (
        [fs.getFileStatus(jpath)] if fs.exists(jpath) else [])
    out, todo = [], list(found or [])
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            todo.extend(s for s in fs.listStatus(status.getPath())
                        if not s.getPath().getName().startswith(("_", ".")))
        elif not name.startswith(("_", ".")):
            out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


# Quotes inside a quoted cell are doubled, as spreadsheets and data frames write them.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}

#: The longest header that is read from a file, in bytes; files read at once for their headers.
HEADER_BYTES, HEADER_READERS = 1 << 16, 32


def _header_of(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """The cells of a file's first record, None for a file without any."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).open(jpath)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            sc._jsc.hadoopConfiguration()).getCodec(jpath)
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
            jvm.org.apache.commons.io.input.BoundedInputStream(
                codec.createInputStream(stream) if codec else stream, HEADER_BYTES)))
    finally:
        stream.close()
    text = data.decode("utf-8", "ignore").removeprefix("\ufeff")
    for record in csv.reader(io.StringIO(text, newline="")):
        if record:
            return tuple(record)
    return None


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header; the first bytes of every file are read, many files at once."""
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        found = list(pool.map(lambda p: (_header_of(spark, p), p), paths))
    out: dict[tuple[str, ...], list[str]] = {}
    for header, p in found:
        if header is not None:
            out.setdefault(header, []).append(p)
    return out


# Fixed names: what the reader says about a line beside its cells.
LINE_PROBLEM, RAW_LINE, LINE_FILE = "_line_problem", "_raw_line", "_line_file"
SURPLUS, SHORT = "surplus_cells", "short_line"


def _cells_in(raw: Column) -> Column:
    """Cells of a line: commas outside quotes, plus one."""
    bare = F.regexp_replace(raw, r'(?s)"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _read_group(spark: SparkSession, header: tuple[str, ...], paths: list[str],
                schema: T.StructType, multi_line: bool) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{paths[0]}: no column {', '.join(missing)}")
    # cells by position; the first of several columns of one name counts
    layout = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))]
                          + [T.StructField(RAW_LINE, T.StringType())])
    df = (spark.read.schema(layout).options(**CSV_DIALECT, mode="PERMISSIVE", multiLine=multi_line,
                                            enforceSchema=True, columnPruning=False,
                                            columnNameOfCorruptRecord=RAW_LINE).csv(paths))
    surplus = _cells_in(F.col(RAW_LINE)) > len(header)
    # the reader gives the raw line only beside a cell, so a cell is always asked for
    torn = F.col(RAW_LINE).isNotNull() & (F.octet_length(F.coalesce("_c0", F.lit(""))) >= 0)
    return df.select(
        *[F.col(f"_c{header.index(f.name)}").alias(f.name) for f in schema.fields],
        landing_order().alias("_seq"), F.col("_metadata.file_path").alias(LINE_FILE),
        F.when(torn, F.col(RAW_LINE)).alias(RAW_LINE),
        F.when(torn, F.when(surplus, SURPLUS).otherwise(SHORT)).alias(LINE_PROBLEM))


def read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
               null_tokens: list[str] | None = None, on_missing: str = "fail",
               multi_line: bool = False) -> DataFrame | None:
    """Every line of headered CSV files with every declared column as text, ``_seq`` and, for
    lines that do not have as many cells as their header, ``_raw_line``, ``_line_problem`` and
    ``_line_file``.

    Each file is read by its own header: columns are found by name, in any order, extra ones
    are ignored and a missing declared column raises. Files with the same header are read
    together. Empty files and files of a header alone have no lines. ``multi_line`` allows line
    breaks inside quoted cells, at the price that a file is read by one task. ``on_missing``:
    "fail" raises, "skip" returns None.
    """
    paths = [path] if isinstance(path, str) else path
    files = [source_files(spark, p) for p in paths]
    missing = [p for p, f in zip(paths, files) if not f and not _exists(spark, p)]
    if missing:
        if on_missing == "skip":
            return None
        raise MissingSourceError(", ".join(missing))
    groups = headers(spark, [p for fs in files for p, size in fs if size])
    parts = [_read_group(spark, h, ps, schema, multi_line) for h, ps in groups.items()]
    if not parts:
        extra = "_seq struct<file:string,block:long,pos:long>, " + ", ".join(
            f"{c} string" for c in (LINE_FILE, RAW_LINE, LINE_PROBLEM))
        return spark.createDataFrame([], T.StructType(
            schema.fields + T.StructType.fromDDL(extra).fields))
    return normalise_nulls(reduce(DataFrame.unionByName, parts), null_tokens,
                           [f.name for f in schema.fields])


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def loaded(lines: DataFrame) -> DataFrame:
    """The rows to load: whole lines, and short ones, whose last cells are missing."""
    return lines.where(F.col(LINE_PROBLEM).isNull() | (F.col(LINE_PROBLEM) == SHORT)) \
        .drop(LINE_PROBLEM, RAW_LINE, LINE_FILE)


def line_audit(lines: DataFrame) -> DataFrame:
    """One row for each line with too many or too few cells: where it stands, its raw text, the
    problem and whether it was loaded."""
    return lines.where(F.col(LINE_PROBLEM).isNotNull()).select(
        F.col(LINE_FILE).alias("file"), "_seq", F.col(RAW_LINE).alias("raw_line"),
        F.col(LINE_PROBLEM).alias("problem"), (F.col(LINE_PROBLEM) == SHORT).alias("loaded"))


def read_raw_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 null_tokens: list[str] | None = None, on_missing: str = "fail",
                 with_seq: bool = True, multi_line: bool = False) -> DataFrame | None:
    """The loadable rows of ``read_lines`` alone."""
    lines = read_lines(spark, path, schema, null_tokens, on_missing, multi_line)
    if lines is None:
        return None
    rows = loaded(lines)
    return rows if with_seq else rows.drop("_seq")
