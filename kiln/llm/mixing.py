"""Mixing sources to target weights by a low-discrepancy schedule.

1. Targets: every source gets its weight's share of the whole; a target above
   ``max_epochs`` times its source's size stops there and the excess is reshared by weight.
2. Blocks: the documents of a source are shuffled (hash order) and laid end to end; the
   stream of words is cut into blocks of the source's own length, short enough that its
   target takes at least ``least_slots`` of them (or blocks of one word). A document is one
   or more spans (block, first word, words).
3. Slots: a source gets all its blocks for every whole epoch that its target holds and the
   nearest number of blocks for the rest, so it is at most half a block off its target.
4. Schedule: slot n of N is the point ``(n * g + g // 2) mod N`` with ``g`` near N times the
   golden ratio and without a common factor, mapped through the cumulative slots to a
   source: every source gets exactly its slots. Slots are ranked within their source; slot
   r of a source takes its block ``r mod blocks`` in epoch ``r div blocks``.
5. Mix: slots joined to the spans of their blocks.

The golden-ratio steps give every prefix of the mix the target proportions to within a
few slots. Prefix sums and ranks are made in two levels (bucket totals, then inside a
bucket), so a source with a third of all rows never meets in one task.

Up to ``max_sources`` sources their table passes the driver and is broadcast. More stay a
table: numbered by a sort in ranges, targets by rounds of distributed sums (only the total
weight and excess of a round reach the driver), slots joined to sources in buckets of places.

Defined results: a null text has size 0; documents of size 0 are in no block and taken 0
times; a null source is a source of its own; repeated rows count one by one; an empty
table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.store import Stage

# Fixed value: the fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
_STEP = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], max_epochs: int = 3) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``max_epochs`` times its size."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(max_epochs * sizes[i] for i in capped)
        weight = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] > max_epochs * sizes[i] * weight]
        if not over:
            return [float(max_epochs * sizes[i]) if i in capped
                    else rest * weights[i] / weight if weight else 0.0
                    for i in range(len(sizes))]
        capped.update(over)


_TABLE = ("src long, key string, source_size long, target double, length long, blocks long, "
          "slots long")


@dataclass
class Mix:
    documents: DataFrame  # doc, size, source and where the document lies in its source
    sources: list[dict] | None  # source, size, target, block length, blocks, slots; None if many
    rows: DataFrame       # slot, source index, epoch, block, row, first word, words


def _block_length(target: float, block: int, least_slots: int) -> int:
    return max(1, min(block, int(target // least_slots)))


def _slot_count(size: int, target: float, length: int, max_epochs: int) -> int:
    """Blocks of ``length`` that take the words nearest to ``target``, epoch by epoch."""
    if not size:
        return 0
    blocks = -(-size // length)
    epochs = min(max_epochs, int(target // size))
    rest = min(blocks, round((target - epochs * size) / length)) if epochs < max_epochs else 0
    return epochs * blocks + rest


def golden_step(slots: int) -> int:
    """A number without a common factor with ``slots``, near their golden section; of the
    nearest ones that with the smallest sum of quotients, which bounds the unevenness."""
    def unevenness(g: int) -> int | None:
        a, b, total = slots, g, 0
        while b:
            total += a // b
            a, b = b, a % b
        return total if a == 1 else None

    middle = round(slots * GOLDEN)
    fits = [(u, abs(g - middle), g) for g in range(max(1, middle - 64), min(slots, middle + 65))
            if (u := unevenness(g)) is not None]
    return min(fits)[2] if fits else 1


def points(n: np.ndarray, slots: int, step: int) -> np.ndarray:
    """Places of the slots ``n``: each of 0 .. slots - 1 once. In two parts, so that no
    product passes 64 bits up to 2**41 slots."""
    far = (n // _STEP) * ((step << 20) % slots) % slots
    return ((n % _STEP) * step + far + step // 2) % slots


def _slots(ends: list[int], chunk: int):
    """Source of every slot: its place among the cumulative slots."""
    edges = np.array(ends, dtype=np.int64)
    slots = max(1, ends[-1])
    step = golden_step(slots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(0).to_numpy()
            src = np.searchsorted(edges, points(n, slots, step), side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(n), pa.array(src.astype(np.int64)), pa.array(n // chunk)],
                ["slot", "src", "chunk"])
    return assign


def _ranked(df: DataFrame, group: str, bucket: str, order: list[str], value: str | None,
            name: str) -> DataFrame:
    """Adds ``name``: the running total of ``value`` (or the count) before each row within
    ``group`` ordered by (bucket, order), from bucket totals and sums inside buckets."""
    amount = F.col(value) if value else F.lit(1)
    earlier = Window.partitionBy(group).orderBy(bucket)
    firsts = (df.groupBy(group, bucket).agg(F.sum(amount).alias("_n"))
              .withColumn("_first", F.sum("_n").over(earlier) - F.col("_n")).drop("_n"))
    inside = (Window.partitionBy(group, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn("_in", F.sum(amount).over(inside) - amount)
            .join(firsts, [group, bucket])
            .withColumn(name, F.col("_in") + F.col("_first")).drop("_in", "_first"))


def _few_sources(totals: list, weights: Sequence[float], block: int, least_slots: int,
                 max_epochs: int) -> list[dict]:
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    share = targets([r["size"] for r in totals],
                    [weights[i % len(weights)] for i in range(len(totals))], max_epochs)
    sources = []
    for i, r in enumerate(totals):
        length = _block_length(share[i], block, least_slots)
        sources.append({"src": i, "source": r["source"], "source_size": r["size"],
                        "target": share[i], "length": length, "blocks": -(-r["size"] // length),
                        "slots": _slot_count(r["size"], share[i], length, max_epochs)})
    return sources


def _many_sources(stage: Stage, totals: DataFrame, whole: int, weights: Sequence[float],
                  bucket_rows: int, block: int, least_slots: int, max_epochs: int) -> DataFrame:
    """The table of any number of sources, with the first place of each."""
    spark = totals.sparkSession
    order = F.col("source").asc_nulls_last()
    ordered = stage.put(totals.repartitionByRange(order).sortWithinPartitions(order).select(
        "source", "size", F.monotonically_increasing_id().alias("id")), "ordered")
    # the id is the partition's number and, in the lower 33 bits, the row's
    part = F.shiftright("id", 33)
    counts = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one row a partition
    before = np.cumsum([0] + [r["count"] for r in counts]).tolist()
    offsets = spark.createDataFrame([(r["part"], n) for r, n in zip(counts, before)],
                                    "part long, before long")
    weight = F.array(*map(F.lit, map(float, weights)))[
        (F.col("src") % len(weights)).cast("int")]
    numbered = stage.put(
        ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
        .withColumn("src", F.col("before") + F.expr("id & 8589934591"))
        .select("src", "source", "size", weight.alias("weight"),
                (F.col("size") * max_epochs).alias("cap")), "numbered")

    # words for a weight of 1; it grows from round to round, so the capped sources stay capped
    rate, capped = 0.0, -1
    while True:
        over = F.col("weight") * rate > F.col("cap")
        n, fixed, free = numbered.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not free:
            break
        rate, capped = (whole - fixed) / free, n

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, share = b.column("source_size").to_pylist(), b.column("target").to_pylist()
            lengths = [_block_length(t, block, least_slots) for t in share]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lengths, pa.int64()),
                 pa.array([-(-n // k) for n, k in zip(sizes, lengths)], pa.int64()),
                 pa.array([_slot_count(n, t, k, max_epochs)
                           for n, t, k in zip(sizes, share, lengths)], pa.int64())],
                [*b.schema.names, "length", "blocks", "slots"])

    share = F.least(F.col("weight") * rate, F.col("cap").cast("double"))
    shaped = numbered.select("src", F.col("source").alias("key"), F.col("size").alias("source_size"),
                             share.alias("target")).mapInArrow(shape, _TABLE)
    return stage.put(
        _ranked(shaped.withColumn("_all", F.lit(0))
                .withColumn("_bucket", F.floor(F.col("src") / bucket_rows)),
                "_all", "_bucket", ["src"], "slots", "place").drop("_all", "_bucket"), "sources")


def _slots_of_many(table: DataFrame, slots: int, chunk: int, places: int = 65_536) -> DataFrame:
    """``slot, src, chunk`` by the places of ``table``: in every bucket of places, slots and
    first places of sources are merged in order; the source open at a bucket's start is
    brought in from the buckets before."""
    spark = table.sparkSession
    step = golden_step(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(0).to_numpy()
            at = points(n, max(1, slots), step)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at // places), pa.array(at), pa.array(n), pa.nulls(len(n), pa.int64())],
                ["bucket", "place", "slot", "src"])

    none = F.lit(None).cast("long").alias("slot")
    starts = table.filter("slots > 0").select(
        F.expr(f"place div {places}").alias("bucket"), "place", none, "src")
    # one row per bucket of places
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    brought = (spark.range(-(-slots // places)).withColumnRenamed("id", "bucket")
               .join(starts.groupBy("bucket").agg(F.max("src").alias("src")), "bucket", "left")
               .select("bucket", F.lit(-1).cast("long").alias("place"), none,
                       F.last("src", ignorenulls=True).over(earlier).alias("src")))
    inside = (Window.partitionBy("bucket").orderBy("place", F.col("slot").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (spark.range(slots).mapInArrow(place, "bucket long, place long, slot long, src long")
            .unionByName(starts).unionByName(brought)
            .withColumn("src", F.last("src", ignorenulls=True).over(inside))
            .filter("slot IS NOT NULL")
            .select("slot", "src", F.expr(f"slot div {chunk}").alias("chunk")))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        min_slots: int = 65_536, max_block: int = 2048, bucket_rows: int = 4096,
        max_sources: int = 100_000, least_slots: int = 64) -> Mix:
    """The mix of all documents. ``weights`` repeat over the sources in code point order,
    null last. Blocks have ``max_block`` words, fewer where the corpus has under
    ``min_slots`` such blocks or a source's target under ``least_slots``."""
    spark = docs.sparkSession
    stage = Stage(spark, "mix")
    sized = stage.put(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"),
        F.col(source_col).alias("source"),
        # repeated rows get places of their own; the order is by content, so reruns agree
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash")), "sizes")
    totals = stage.put(sized.groupBy("source").agg(F.sum("size").alias("size"),
                                                   F.count("*").alias("n")), "totals")
    count, whole, rows = totals.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)),
                                    F.coalesce(F.sum("n"), F.lit(0))).first()
    block = max(1, min(max_block, whole // min_slots))
    shape = (block, least_slots, max_epochs)
    if count <= max_sources:
        sources = _few_sources(totals.collect(), weights, *shape)
        table = F.broadcast(spark.createDataFrame([tuple(s.values()) for s in sources], _TABLE))
    else:
        sources, table = None, _many_sources(stage, totals, whole, weights, bucket_rows, *shape)
    buckets = max(1, rows // bucket_rows)
    placed = (sized.join(table, sized["source"].eqNullSafe(table["key"]))
              .withColumn("bucket", F.pmod("hash", F.lit(buckets))))
    placed = stage.put(
        _ranked(placed, "src", "bucket", ["hash", "doc_id", "size"], "size", "at")
        .select("doc_id", "size", "src", "source", "source_size", "target", "hash", "at",
                "length", "slots"),
        "places")

    first = F.expr("at div length")
    # a source whose target is below its size takes its first blocks only
    last = F.least(F.expr("(at + size - 1) div length"), F.col("slots") - 1)
    spans = (placed.filter((F.col("size") > 0) & (first < F.col("slots")))
             .withColumn("block", F.explode(F.sequence(first, last)))
             .withColumn("start", F.greatest(F.expr("block * length"), "at") - F.col("at"))
             .withColumn("words", F.least(F.expr("(block + 1) * length"),
                                          F.col("at") + F.col("size")) - F.col("at")
                         - F.col("start"))
             .select("src", "block", "doc_id", "hash", "at", "start", "words"))

    if sources is not None:
        ends = np.cumsum([s["slots"] for s in sources], dtype=np.int64).tolist() or [0]
        slots = ends[-1]
        drawn = spark.range(slots).mapInArrow(_slots(ends, bucket_rows),
                                                 "slot long, src long, chunk long")
    else:
        slots = table.agg(F.sum("slots")).first()[0]
        drawn = stage.put(_slots_of_many(table, slots, bucket_rows), "drawn")
    drawn = _ranked(drawn, "src", "chunk", ["slot"], None, "rank")
    per = table.select(F.col("src").alias("_src"), "blocks")
    per = per if sources is None else F.broadcast(per)
    taken = (drawn.join(per, F.col("src") == F.col("_src"))
             .withColumn("epoch", F.expr("rank div blocks"))
             .withColumn("block", F.col("rank") % F.col("blocks"))
             .select("slot", "src", "epoch", "block"))
    # many short blocks make more spans than the planner expects of the documents
    spans = spans if slots <= 4 * min_slots else spans.hint("merge")
    return Mix(placed, sources, taken.join(spans, ["src", "block"]))


def taken_per_document(m: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of the input."""
    taken = m.rows.groupBy("src", "at", "doc_id", "hash").agg(F.sum("words").alias("taken"))
    d, t = m.documents.alias("d"), taken.alias("t")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("src", "at", "hash", "doc_id")]
    return d.join(t, [*same, F.col("d.size") > 0], "left").select(
        "d.doc_id", "d.size", "d.source_size", "d.target",
        F.coalesce("t.taken", F.lit(0)).alias("taken"))
