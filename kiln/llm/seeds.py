"""Repeats of a fixed length across documents, found from sampled suffixes.

Documents are sequences of units (words or bytes); a window is ``window`` consecutive
units. Of the ``gram``-unit grams in every window the one with the smallest hash is its
seed (the leftmost of equal ones), so equal windows have equal seeds at equal places, and
only seeds - a small share of all positions - have to be compared:

1. ``anchors``: seeds of every different text, whole texts (of equal texts the one with
   the smallest id stands for all); those whose gram occurs once in the
   whole corpus are dropped (counts are combined map-side, the join back is a plain join
   that adaptive execution can split where a gram is hot).
2. ``occurrences``: each remaining seed with a digest of its context, the ``window - gram``
   units before it and the ``window`` units from it on. Every window that holds the seed
   lies in the context.
3. ``contexts``: equal contexts are collapsed; copies cost one row however many there are.
   Only grams with several different contexts go on, with the contexts' units.
4. A solver (suffix tree or suffix array) compares the contexts of a gram, many grams at a
   time, with groups bounded by ``max_group`` contexts. Grams with more contexts are solved
   without grouping: each of their windows becomes a row, aggregated by its 128-bit digest.
   With ``in_halves`` their contexts are first grouped by a longer string: a window that holds
   the gram holds half of the ``window - gram`` units left of it or half of them right of it,
   so contexts that share a window agree in one of two keys. Only groups of a key that are
   still too large are solved by windows, and only by those of their half.

Texts are dealt once into a table bucketed by document key in the shared folder, zstd
compressed; the later passes over texts read it without shuffling them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.memory import gives_back
from kiln.llm.minhash import _ODD, _scramble, word_hashes
from kiln.llm.store import Stage

LAST = 2 ** 63 - 1  # the order of a null id: after all others
#: Grams are told apart by 48 bits: a chance agreement only adds a candidate.
_GRAM_BITS = np.uint64(16)


@dataclass(frozen=True)
class Units:
    """Words (64-bit hashes) or bytes of a text."""
    words: bool
    window: int
    gram: int

    @property
    def left(self) -> int:
        return self.window - self.gram

    @property
    def texts_at_once(self) -> int:
        """Few enough for their hashes to stay in the processor's cache."""
        return 128 if self.words else 16

    @property
    def width(self) -> int:
        return 8 if self.words else 1

    def of(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts, one after the other, and where each text's end."""
        if self.words:
            return word_hashes(raws)
        return np.frombuffer(b"".join(raws), np.uint8), np.cumsum([len(r) for r in raws])

    def grams(self, units: np.ndarray) -> np.ndarray:
        """Hashes of the grams at every position that has one."""
        n = max(0, len(units) - self.gram + 1)
        h = np.zeros(n, np.uint64)
        if self.words:
            for i in range(self.gram):
                h = _scramble(h + units[i:i + n] * _ODD[i])
        elif n:  # eight bytes at a time
            eight = np.ndarray(len(units) - 7, "<u8", units, strides=(1,))
            for i in range(0, self.gram, 8):
                h = _scramble(h + eight[i:i + n] * _ODD[i % 64])
        return h >> _GRAM_BITS

    def seeds(self, units: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and gram hashes of the seeds of all windows inside one text."""
        if len(units) < self.window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = self.grams(units)
        at = sliding_argmin(h, self.window - self.gram + 1)
        crossing = np.zeros(len(at) + self.window, np.int32)
        for end in ends[:-1].tolist():  # windows over the end of a text
            crossing[max(0, end - self.window + 1):end] = 1
        at = at[crossing[:len(at)] == 0]
        at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        return at, h[at]


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least of 48-bit values in every stretch of ``width``.

    Stretches are cut at multiples of ``width``; the least value is that of a suffix of one
    block or of a prefix of the next. Value and place within the block are one number, so a
    running minimum finds both."""
    n = len(h)
    bits = np.uint64(max(1, width.bit_length()))
    pad = np.full(-n % width, 2 ** 48 - 1, np.uint64)
    offset = np.arange(width, dtype=np.uint64)
    both = (np.concatenate([h, pad]).reshape(-1, width) << bits) | offset
    suffix = np.minimum.accumulate(both[:, ::-1], axis=1)[:, ::-1].ravel()
    prefix = np.minimum.accumulate(both, axis=1).ravel()
    start = np.arange(n - width + 1)
    s, p = suffix[start], prefix[start + width - 1]
    mask = np.uint64((1 << int(bits)) - 1)
    first = start - start % width
    last = (start + width - 1) - (start + width - 1) % width
    return np.where((s >> bits) <= (p >> bits), first + (s & mask).astype(np.int64),
                    last + (p & mask).astype(np.int64))


@gives_back
def pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd-compressed UTF-8."""
    zip_ = zstandard.ZstdCompressor(level=3)
    for b in _slices(batches, 256):
        packed = [None if t is None else zip_.compress(t.encode("utf-8", "surrogatepass"))
                  for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc", "doc_id", "text_hash", "size", "rest")),
             pa.array(packed, pa.binary())],
            ["doc", "doc_id", "text_hash", "size", "rest", "packed"])


class Unpacker:
    def __init__(self):
        self.zip = zstandard.ZstdDecompressor()

    def __call__(self, packed: bytes | None) -> bytes:
        return b"" if packed is None else self.zip.decompress(packed)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _anchors(units: Units):
    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = Unpacker()
        for b in _slices(batches, units.texts_at_once):
            all_units, ends = units.of([unpack(x.as_py()) for x in b.column("packed")])
            at, grams = units.seeds(all_units, ends)
            text = np.searchsorted(ends, at, side="right")
            start = np.r_[0, ends][text]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(text)), pa.array(grams.view(np.int64)),
                 pa.array((at - start).astype(np.int32))], ["doc", "gram", "at"])
    return work


def _contexts(units: Units, with_units: bool):
    """Rows for the ``seeds`` of each document: the context's digest or its units."""
    width = units.width

    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = Unpacker()
        for b in _slices(batches, 128):
            rows: list[tuple] = []
            all_units, ends = units.of([unpack(x.as_py()) for x in b.column("packed")])
            raw = all_units.tobytes()
            first = 0
            for doc, doc_id, end, seeds in zip(
                    b.column("doc").to_pylist(), b.column("doc_id").to_pylist(), ends.tolist(),
                    b.column("seeds").to_pylist()):
                for s in seeds:
                    at = first + s["at"]
                    lo, hi = max(first, at - units.left), min(end, at + units.window)
                    context = raw[lo * width:hi * width]
                    if with_units:
                        rows.append((s["gram"], s["context"], s["copies"], s["first_doc"],
                                     at - lo, context))
                    else:
                        # where the context is cut short belongs to it
                        digest = xxhash.xxh3_64_intdigest(context, seed=at - lo)
                        rows.append((doc, doc_id, s["gram"], digest - 2 ** 63, s["at"], at - lo,
                                     hi - at))
                first = end
            names = ["gram", "context", "copies", "first_doc", "before", "units"] \
                if with_units else ["doc", "doc_id", "gram", "context", "at", "before", "after"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()] \
                if with_units else [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                                    pa.int32(), pa.int32()]
            cols = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names)
    return work


def _halves(units: Units):
    """Rows of contexts, one for each half of the units around the gram that they hold: ``gram``
    is the key of gram and half, ``of`` the gram, ``least`` to ``most`` the places of the gram
    in the windows that hold that half."""
    half, width = units.left // 2, units.width

    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows, left = [], [], []
            for i, (g, before, raw) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                    "gram", "before", "units")))):
                for is_left, lo, hi in ((False, before, before + units.gram + units.left - half),
                                        (True, before - half, before + units.gram)):
                    if lo >= 0 and hi * width <= len(raw):
                        digest = xxhash.xxh3_64_intdigest(raw[lo * width:hi * width],
                                                          seed=2 * (g & (2 ** 62 - 1)) + is_left)
                        keys.append(digest - 2 ** 63)
                        rows.append(i)
                        left.append(is_left)
            at, left = pa.array(rows, pa.int64()), np.array(left, bool)
            cols = {c: b.column(c).take(at) for c in b.schema.names}
            cols |= {"of": cols["gram"], "gram": pa.array(keys, pa.int64()),
                     "least": pa.array(np.where(left, half, 0).astype(np.int32)),
                     "most": pa.array(np.where(left, units.left, half - 1).astype(np.int32))}
            yield pa.RecordBatch.from_pydict(cols)
    return work


_OCCURRENCE = ("doc long, doc_id long, gram long, context long, at int, before int, after int")
_CONTEXT = "gram long, context long, copies long, first_doc long, before int, units binary"
_HALF = _CONTEXT + ", of long, least int, most int"

#: A solver gets the arrays gram, context, copies, first_doc, before and a list of units
#: (bytes) of whole groups, and returns the columns of its result, gram and context first.
Solver = Callable[..., list[np.ndarray]]


def _solve(units: Units, solver: Solver, kinds: list[pa.DataType], names: list[str],
           rows_at_once: int):
    """Runs the solver on whole groups of rows that arrive sorted by gram."""
    def solved(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        cols = [t.column(c).to_numpy() for c in ("gram", "context", "copies", "first_doc",
                                                 "before")]
        out = solver(units, *cols, t.column("units").to_pylist())
        if "of" in t.schema.names:  # back from the keys of halves to the grams
            keys, first = np.unique(cols[0], return_index=True)
            out[0] = t.column("of").to_numpy()[first][np.searchsorted(keys, out[0])]
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(out, kinds)], names)

    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= rows_at_once:
                last = b.column("gram")[b.num_rows - 1].as_py()
                grams = b.column("gram").to_numpy()
                cut = int(np.searchsorted(grams, last))  # the last group may go on
                if cut:
                    held[-1] = b.slice(0, cut)
                    yield solved(held)
                    held, size = [b.slice(cut)], b.num_rows - cut
        if size:
            yield solved(held)
    return work


class RepeatFinder:
    def __init__(self, docs: DataFrame, units: Units, id_col: str, text_col: str, name: str,
                 with_rest: bool = False):
        self.spark, self.units = docs.sparkSession, units
        self.stage = Stage(self.spark, name)
        others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
        self.texts = self._bucketed(docs.select(
            F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc"),
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
            F.coalesce(F.length(F.col(text_col)), F.lit(0)).alias("size"),
            F.struct(*(others if with_rest and others else [F.lit(0).alias("_")])).alias("rest")))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        from pyspark.sql.types import BinaryType, StructField, StructType
        kept = [f for f in rows.schema.fields if f.name != "text"]
        packed = rows.mapInArrow(pack_text, StructType([*kept, StructField("packed", BinaryType())]))
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"kiln_texts_{uuid.uuid4().hex}"
        (packed.repartition(buckets, "doc").write.bucketBy(buckets, "doc").format("parquet")
         .option("path", self.stage.path("texts")).saveAsTable(table))
        texts = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # the scan is resolved, its files stay
        return texts

    def copies(self) -> tuple[DataFrame, DataFrame]:
        """Texts that occur once or come first among equal ones (``doc``), and the rows of
        texts with several copies: ``doc, later`` (later: of a larger id than the first)."""
        order = F.coalesce("doc_id", F.lit(LAST))
        rows = self.texts.select("doc", "text_hash", "size", order.alias("o"))
        classes = self.stage.put(
            rows.groupBy("text_hash", "size").agg(F.count("*").alias("n"),
                                                  F.min(F.struct("o", "doc")).alias("first")),
            "copies")
        copied = (rows.join(classes.filter("n > 1"), ["text_hash", "size"])
                  .groupBy("doc").agg(F.max(F.col("o") > F.col("first.o")).alias("later")))
        return classes.select(F.col("first.doc").alias("doc")), copied

    def occurrences(self, firsts: DataFrame) -> DataFrame:
        """Seeds of the texts in ``firsts`` whose gram occurs twice or more."""
        anchors = self.texts.select("doc", "packed").join(firsts, "doc", "left_semi").mapInArrow(
            _anchors(self.units), "doc long, gram long, at int")
        shared = self.stage.put(
            anchors.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"),
            "shared-grams")
        kept = anchors.join(shared, "gram").groupBy("doc").agg(
            F.collect_set(F.struct("gram", "at")).alias("seeds"))  # of one document
        out = self.stage.put(
            self.texts.select("doc", "doc_id", "packed").join(kept, "doc").mapInArrow(
                _contexts(self.units, False), _OCCURRENCE), "occurrences")
        self.stage.drop(shared)
        return out

    def contexts(self, occurrences: DataFrame) -> DataFrame:
        """One row per different context: copies, smallest document, one place of it."""
        return self.stage.put(
            occurrences.groupBy("gram", "context").agg(
                F.count("*").alias("copies"),
                F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first_doc"),
                F.min(F.struct("doc", "at")).alias("place"),
                F.first("before").alias("before"), F.first("after").alias("after")), "contexts")

    def solve(self, contexts: DataFrame, solver: Solver, schema: str,
              oversize: Callable[[DataFrame], DataFrame], max_group: int,
              rows_at_once: int = 10_000, in_halves: bool = False) -> DataFrame:
        """The solver's rows for the contexts of grams that have several contexts. With
        ``in_halves``, the solver's results for a context must add up by maxima, and
        ``oversize`` gets rows of halves."""
        sizes = self.stage.put(contexts.groupBy("gram").agg(F.count("*").alias("n_contexts"))
                               .filter("n_contexts > 1"), "group-sizes")

        def with_units(grams: DataFrame) -> DataFrame:
            fetched = contexts.join(grams.select("gram"), "gram").groupBy(
                F.col("place.doc").alias("doc")).agg(F.collect_list(F.struct(
                    "gram", "context", "copies", "first_doc", F.col("place.at").alias("at")))
                .alias("seeds"))
            # texts that share document key and place come back twice: solvers allow it
            return self.texts.select("doc", "doc_id", "packed").join(fetched, "doc").mapInArrow(
                _contexts(self.units, True), _CONTEXT)

        from pyspark.sql.types import _parse_datatype_string
        from pyspark.sql.pandas.types import to_arrow_type
        fields = _parse_datatype_string(schema).fields
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

        def in_groups(rows: DataFrame) -> DataFrame:
            return (rows.repartition(parts, "gram").sortWithinPartitions("gram", "context")
                    .mapInArrow(_solve(self.units, solver, [to_arrow_type(f.dataType) for f in fields],
                                       [f.name for f in fields], rows_at_once), schema))

        solved = in_groups(with_units(sizes.filter(F.col("n_contexts") <= max_group)))
        # every one of these grams has over max_group contexts, so they are few
        many = F.broadcast(sizes.filter(F.col("n_contexts") > max_group))
        if many.isEmpty():
            return solved
        if not in_halves:
            return solved.unionByName(oversize(with_units(many)))
        halves = self.stage.put(with_units(many).mapInArrow(_halves(self.units), _HALF), "halves")
        sizes = self.stage.put(halves.groupBy("gram").agg(F.count("*").alias("n_contexts"))
                               .filter("n_contexts > 1"), "half-sizes")
        solved = solved.unionByName(in_groups(halves.join(
            sizes.filter(F.col("n_contexts") <= max_group).select("gram"), "gram")))
        many = F.broadcast(sizes.filter(F.col("n_contexts") > max_group).select("gram"))
        if not many.isEmpty():
            solved = solved.unionByName(oversize(halves.join(many, "gram")))
        return solved

    def window_rows(self, rows: DataFrame) -> DataFrame:
        """``gram, context, back, window, copies, first_doc``: every window of the contexts
        by digest; ``back`` is how far before the seed it starts. For halves, only the windows
        from ``least`` to ``most``, with the gram in ``of``."""
        units = self.units
        half = "of" in rows.columns

        @gives_back
        def work(batches):
            step = units.width
            for b in batches:
                out: list[tuple] = []
                of, least, most = (b.column(k).to_pylist() for k in ("of", "least", "most")) \
                    if half else (b.column("gram").to_pylist(), [0] * b.num_rows,
                                  [units.left] * b.num_rows)
                for g, c, n, d, before, raw, o, first, last in zip(*(b.column(k).to_pylist() for k in (
                        "gram", "context", "copies", "first_doc", "before", "units")), of, least, most):
                    size = len(raw) // step
                    for back in range(first, min(before, last) + 1):
                        lo = before - back
                        if lo + units.window <= size:
                            out.append((g, c, back, xxhash.xxh3_128_digest(
                                raw[lo * step:(lo + units.window) * step]), n, d, o))
                cols = zip(*out) if out else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (
                        pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(),
                        pa.int64()))],
                    ["gram", "context", "back", "window", "copies", "first_doc", "of"])
        return rows.mapInArrow(
            work, "gram long, context long, back int, window binary, copies long, first_doc long,"
                  " of long")
