"""Vector code compression: product codebooks fitted by ball k-means in integers.

Vectors are scaled to integers and cut into equal parts; every part position has a codebook.
A round gives each part to its nearest entry (exact squared distances, ties to the lower
index) and then moves every entry to the floored mean of its parts. Ball k-means keeps the
work small without changing a result: the parts of an entry form a ball, and only entries
whose gap to it is at most twice the ball's radius are its neighbours. Sorted by distance, the
parts fall into a core that no neighbour can reach and into rings; a ring is compared with
the neighbours up to its number only. A ball whose entry and neighbours stood still is not
looked at again. Sums are kept up by the parts that moved.

A round is one pass over a table of ``(vector, codes)`` that writes the next one, with each
task's changes of the sums beside the rows; what reaches the driver is one codebook's worth of
numbers, whatever the table's size. No row is shuffled before the last step.

Defined results: vectors that are null, hold null or non-finite components, or whose length
is no positive multiple of ``parts`` are dropped, as are those of another length than the
first kept vector. Scaled components saturate at 2**24 either way (with a scale of 4096: at
4096.0), so that all distances are exact. Seeds are the smallest ids, null ids last, repeated
ids by their vectors; with fewer vectors than entries the codebook has as many entries as
vectors. An empty table gives no rows. Null labels form one group; label sums saturate at the
largest long. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.store import Stage

SATURATE = 1 << 24
LONG_MAX = 2 ** 63 - 1


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold finite components only."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -SATURATE, SATURATE).astype(np.int32)


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = x - entry
    return np.einsum("ij,ij->i", d, d)


def entry_gaps(entries: np.ndarray) -> np.ndarray:
    """Squared distances between the entries of one codebook."""
    return np.stack([squared(entries, e) for e in entries])


def ball_assign(x: np.ndarray, entries: np.ndarray, gaps: np.ndarray, old: np.ndarray,
                still: np.ndarray, measure_still: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each part, starting from the balls of ``old``.

    Balls marked in ``still`` keep their parts; their distances are 0 unless asked for."""
    code, dist = old.copy(), np.zeros(len(x), np.int64)
    for i in np.unique(old):
        rows = np.flatnonzero(old == i)
        if still[i]:
            if measure_still:
                dist[rows] = squared(x[rows], entries[i])
            continue
        own = squared(x[rows], entries[i])
        order = np.argsort(own, kind="stable")
        rows, own = rows[order], own[order]
        best, at = own.copy(), np.full(len(rows), i, old.dtype)
        reach = 4 * own                       # an entry farther than twice the distance loses
        for j in np.argsort(gaps[i], kind="stable"):
            if gaps[i, j] > reach[-1]:        # no neighbour of the ball, nor are later ones
                break
            if j == i:
                continue
            ring = np.searchsorted(reach, gaps[i, j])
            d = squared(x[rows[ring:]], entries[j])
            b, a = best[ring:], at[ring:]
            wins = (d < b) | ((d == b) & (j < a))
            b[wins], a[wins] = d[wins], j
        code[rows], dist[rows] = at, best
    return code, dist


_ROUND = "kind string, vec_id long, label {label}, vector binary, codes binary, slot int, value long"


def _first_pass(dim: int, parts: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = scaled(b.column("vector").flatten().to_numpy(zero_copy_only=False), scale)
            rows = [r.tobytes() for r in x.reshape(-1, dim)]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(rows, pa.binary())],
                ["vec_id", "label", "vector"])
    return run


def _matrix(b: pa.RecordBatch, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("vector").to_pylist()), np.int32).reshape(-1, dim)


def _round_pass(books: np.ndarray, still: np.ndarray, first: bool):
    """One assignment: rows with their new codes, then the task's changes of sums and counts
    (``sum``) and the radii of its balls (``max``)."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = [entry_gaps(e) for e in books]
        sums = np.zeros((parts, k, width + 1), np.int64)
        radius = np.full((parts, k), -1, np.int64)
        names, kind = None, None
        for b in batches:
            names, kind = b.schema.names, b.schema.field("label").type
            x = _matrix(b, parts * width)
            old = np.zeros((len(x), parts), np.uint8) if first else np.frombuffer(
                b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
            new = np.empty_like(old)
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width].astype(np.int64)
                new[:, p], dist = ball_assign(part, books[p], gaps[p], old[:, p], still[p])
                counted = np.concatenate([part, np.ones((len(x), 1), np.int64)], axis=1)
                moved = slice(None) if first else np.flatnonzero(new[:, p] != old[:, p])
                np.add.at(sums[p], new[moved, p], counted[moved])
                if not first:
                    np.subtract.at(sums[p], old[moved, p], counted[moved])
                np.maximum.at(radius[p], new[:, p], dist)
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["row"] * n), b.column("vec_id"), b.column("label"),
                 b.column("vector"), pa.array([r.tobytes() for r in new], pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                ["kind", "vec_id", "label", "vector", "codes", "slot", "value"])
        if names is None:
            return
        flat, r = sums.reshape(-1), radius.reshape(-1)
        at, seen = np.flatnonzero(flat), np.flatnonzero(r >= 0)
        n = len(at) + len(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(["sum"] * len(at) + ["max"] * len(seen), pa.string()),
             pa.nulls(n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, pa.binary()),
             pa.nulls(n, pa.binary()),
             pa.array(np.concatenate([at, seen]).astype(np.int32)),
             pa.array(np.concatenate([flat[at], r[seen]]))],
            ["kind", "vec_id", "label", "vector", "codes", "slot", "value"])
    return run


def _last_pass(books: np.ndarray, still: np.ndarray, first: bool):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = [entry_gaps(e) for e in books]
        for b in batches:
            x = _matrix(b, parts * width)
            old = np.zeros((len(x), parts), np.uint8) if first else np.frombuffer(
                b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
            new, error = np.empty_like(old), np.zeros(len(x), np.int64)
            for p in range(parts):
                new[:, p], dist = ball_assign(
                    x[:, p * width:(p + 1) * width].astype(np.int64), books[p], gaps[p],
                    old[:, p], still[p], measure_still=True)
                error += dist
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"),
                 pa.array([r.tobytes().hex() for r in new], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"])
    return run


def standing_balls(books: np.ndarray, moved: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Balls whose entry and every neighbour stood still since the last assignment."""
    still = np.zeros(moved.shape, bool)
    for p, entries in enumerate(books):
        near = entry_gaps(entries) <= 4 * np.maximum(radius[p], 0)[:, None]
        np.fill_diagonal(near, True)
        still[p] = ~(near & moved[p][None, :]).any(axis=1)
    return still


def seeds(vectors: DataFrame, entries: int) -> np.ndarray | None:
    """Scaled vectors of the smallest ids; ``entries`` rows at most reach the driver."""
    rows = (vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries)
            .select("vector").collect())
    return np.array([r.vector for r in rows], np.float64) if rows else None


def compress(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id",
             label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: float = 4096.0) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector.

    ``code`` has two hex digits a part; ``entries`` is 256 at most."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = vectors.sparkSession
    stage = Stage(spark, "ball-codes")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vec).cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector"))
                       & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    kind = dict(rows.dtypes)["label"]
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1) \
        .select(F.size("vector")).collect()
    dim = first[0][0] if first else parts
    rows = rows.filter(F.size("vector") == dim)
    start = seeds(rows, entries)
    if start is None:
        start = np.zeros((0, dim))
    k, width = len(start), dim // parts
    # (part, entry, position)
    books = scaled(start, scale).astype(np.int64).reshape(k, parts, width).transpose(1, 0, 2).copy()
    table = stage.put(rows.mapInArrow(_first_pass(dim, parts, scale),
                                      f"vec_id long, label {kind}, vector binary"), "scaled")
    sums = np.zeros((parts, k, width + 1), np.int64)
    radius = np.full((parts, k), -1, np.int64)
    still = np.zeros((parts, k), bool)
    for n in range(rounds if k else 0):
        schema = _ROUND.format(label=kind)
        where = stage.path(f"round{n}")
        table.mapInArrow(_round_pass(books, still, n == 0), schema) \
            .write.partitionBy("kind").parquet(where)
        written = spark.read.schema(schema).parquet(where)
        # one number for each component of the codebooks, and one radius for each entry
        numbers = (written.filter("kind <> 'row'").groupBy("kind", "slot")
                   .agg(F.sum("value").alias("s"), F.max("value").alias("m")).collect())
        keep = radius.copy()
        radius = np.where(still, keep, -1)
        for r in numbers:
            if r.kind == "sum":
                sums.reshape(-1)[r.slot] += r.s
            elif not still.reshape(-1)[r.slot]:
                radius.reshape(-1)[r.slot] = r.m
        count = sums[:, :, width:]
        after = np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)
        still = standing_balls(after, (after != books).any(axis=2), radius)
        books = after
        stage.drop(table)
        table = written.filter("kind = 'row'").select("vec_id", "label", "vector", "codes")
        table._kiln_path = where
    coded = stage.put(table.mapInArrow(_last_pass(books, still, rounds == 0),
                                       f"vec_id long, label {kind}, code string, error long")
                      if k else spark.createDataFrame([], f"vec_id long, label {kind}, "
                                                          "code string, error long"), "coded")
    stage.drop(table)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX)).cast("long")
    sums_by_label = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return coded.join(sums_by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
