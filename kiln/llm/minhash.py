"""MinHash near-dedup with tensored banding.

A document's set holds its distinct word shingles (64-bit hashes of word sequences).
``collections`` small collections of ``rows`` minhashes each are computed, and the keys of
the hash tables are pairs of collections: 16 collections of 3 give 120 tables of 6 rows
from 48 minhashes instead of 720. Two sets meet in a table as soon as two of the 16
collections agree: at similarity 0.85 this fails for 7 pairs in a million, at 0.8 for 2 in
10,000. Every candidate is verified on the full sets.

Steps and their bounds:

* Equal sets are collapsed first by a partial aggregation, so copies cost nothing.
* Only sets that share at least two collection values with other sets emit table keys (a
  pair of collections cannot agree where one of them is unique), which spares nearly all
  documents the keys.
* The value of one collection is a key by itself if few sets hold it, or if its sets agree so
  often in the next collection that its pairs would hardly be fewer. Only the other values of
  a set are joined to pairs. Sets that agree in two values meet: by either value that is a key
  by itself, else by both together. Alike sets so share at most 16 keys, not 120.
* Shingles that no other set of any bucket holds are counted for every set. They are part of
  the difference of each pair, which rules most pairs out that are alike but not alike enough:
  ``(100 - percent) * (n_a + n_b) >= (100 + percent) * (own_a + own_b)`` holds for all links.
* Of buckets with the same members, one is compared. Buckets are compared with pivots, round
  by round: each member with the pivot unless both are already connected or the bound or
  their sizes rule a link out. First every bucket has one pivot, the set with the least of
  its own, which connects most groups of copies by one comparison a member; then pivots per
  bucket grow 512-fold each round. A bucket is done when its members that were not a pivot
  yet are connected or ruled out, so no link between components is lost.
* A pair becomes a row only if its odd sketches allow a link: a bit of a sketch is the parity
  of the set's shingles that fall on it, so the bits in which two sketches differ are at most
  the shingles in which the sets do. A link has ``(100 + percent) * differing <= (100 - percent)
  * (n_a + n_b)``; nothing is lost. Sets that are alike but not linked are compared in pairs
  still (16 words each), but hardly any of these pairs is written or sees its whole sets.
* Texts of bucket members, and collection values that several sets hold, are few: a bitmap of
  their hashes, bounded in size, drops nearly all other rows before the join that decides.

Defined results: null and word-less texts have the empty set and link with nothing; rows
with a null id link with nothing (component null, not kept); rows that share an id share
it in the result, each by its own text; repeated rows get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.graph import components
from kiln.llm.memory import gives_back
from kiln.llm.store import Stage

_ODD = np.random.default_rng(5).integers(1, 2 ** 63, size=64, dtype=np.uint64) * 2 + 1


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words end.

    Words are split at ASCII white space; all texts are hashed together, eight bytes of
    every word at a time."""
    buf = np.frombuffer(b" ".join(raws) + b" " * 8, np.uint8)
    inside = (buf != 32) & ((buf < 9) | (buf > 13))
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    h = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows, at = np.arange(len(starts)), 0
    while len(rows):
        part = eight[starts[rows] + at] & _LOW_BYTES[np.minimum(sizes[rows] - at, 8)]
        h[rows] = _scramble(h[rows] * np.uint64(0xA0761D6478BD642F) + part)
        at += 8
        rows = rows[sizes[rows] > at]
    ends = np.cumsum([len(r) + 1 for r in raws])
    return h, np.searchsorted(starts, ends)


_LOW_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of ``size`` consecutive words of each text (of all its words
    if it has fewer), A-Z lower-cased."""
    words, ends = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower()
                               for t in texts])
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = _scramble(h + words[i:i + n] * _ODD[i])
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= size or end == start:
            out.append(np.unique(h[start:max(start, end - size + 1)]))
        else:
            few = np.zeros(1, np.uint64)
            for i in range(end - start):
                few = _scramble(few + words[start + i:start + i + 1] * _ODD[i])
            out.append(few)
        start = end
    return out


class MinHasher:
    """Values of the collections of a set, each mixing ``rows`` minhashes."""

    def __init__(self, collections: int, rows: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        n = collections * rows
        self.shape = (collections, rows)
        self.factors = rng.integers(1, 2 ** 63, size=n, dtype=np.uint64) * 2 + 1
        self.offsets = rng.integers(0, 2 ** 63, size=n, dtype=np.uint64)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(len(self.factors), 2 ** 64 - 1, np.uint64)
        for at in range(0, len(hashes), 256):  # pieces that stay in the processor's cache
            h = hashes[at:at + 256] * self.factors[:, None]
            h += self.offsets[:, None]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            np.minimum(low, h.min(axis=1), out=low)
        out = np.zeros(self.shape[0], np.uint64)
        for r in range(self.shape[1]):
            out = _scramble(out * np.uint64(0x9E3779B97F4A7C15) + low.reshape(self.shape)[:, r])
        return out


#: A value that at most so many sets hold is a key by itself.
_FEW = 32
#: So is one that more hold, if comparing all of them makes at most so many times the pairs
#: that also agree in the next collection.
_DENSE = 8

#: Words of 64 bits in an odd sketch.
_ODD_WORDS = 16


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity of the hashes that fall on each bit. Two sketches differ in no more bits than
    the sets differ in hashes."""
    n = 64 * _ODD_WORDS
    odd = np.bincount((hashes % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


#: Bits of one row of a bitmap, as ``bitmap_construct_agg`` has them.
_BITMAP_ROW = 32_768


def likely(rows: DataFrame, key, wanted: DataFrame, wanted_key, at_most: int = 2 ** 26) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the ``wanted`` keys: all that
    are wanted stay, so a join with ``wanted`` that follows is not changed. The bitmap of hashes
    takes two bytes a key, and never more than ``at_most`` bits; beyond that it spares less."""
    bits = _BITMAP_ROW
    while bits < min(at_most, 16 * wanted.count()):
        bits *= 2
    place = lambda k: F.pmod(F.xxhash64(*k), F.lit(bits))
    bitmap = (wanted.select(place(wanted_key).alias("p")).groupBy((F.col("p") / _BITMAP_ROW).cast("int").alias("_row"))
              .agg(F.bitmap_construct_agg(F.col("p") % _BITMAP_ROW).alias("_bits")))
    names = rows.columns
    bit = F.col("_place") % _BITMAP_ROW
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return (rows.withColumn("_place", place(key))
            .withColumn("_row", (F.col("_place") / _BITMAP_ROW).cast("int"))
            .join(F.broadcast(bitmap), "_row")
            .filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(names))


def _sketch(size: int, collections: int, rows: int):
    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(collections, rows)
        for batch in batches:
            counts, digests, values = [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), size):
                counts.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                values.append(hasher.values(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "digest", "vals"])
    return work


def _full_sets(size: int):
    @gives_back
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(batch.column("text").to_pylist(), size)
                same = [xxhash.xxh3_128_digest(s.tobytes()) == d.as_py()
                        for s, d in zip(sets, batch.column("digest"))]
                keep = [i for i, ok in enumerate(same) if ok]  # of rows that share an id
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(pa.array(keep, pa.int64())),
                     pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                     pa.array([odd_sketch(sets[i]) for i in keep], pa.list_(pa.int64()))],
                    ["rep", "shingles", "odd"])
    return work


class _Dedup:
    def __init__(self, docs: DataFrame, percent: int, size: int, collections: int, rows: int):
        self.spark = docs.sparkSession
        self.stage = Stage(self.spark, "minhash")
        self.docs, self.percent, self.size = docs, percent, size
        self.collections, self.rows = collections, rows

    def _keys(self, reps: DataFrame) -> DataFrame:
        """``key, rep, n``: two sets that share at least two collection values share a key."""
        following = F.col("vals")[(F.col("i") + 1) % self.collections]
        one = (reps.select("rep", "n", "vals", F.posexplode("vals").alias("i", "h"))
               .select("rep", "n", "i", "h", following.alias("next")))
        shared = (one.groupBy("i", "h").agg(F.count("*").alias("c")).filter("c > 1"))
        shared = self.stage.put(shared, "shared-values")
        mine = self.stage.put(
            likely(one, ["i", "h"], shared, ["i", "h"]).join(shared, ["i", "h"])
            .groupBy("rep", "n").agg(F.collect_list(F.struct("i", "h", "next", "c")).alias("have"))
            .filter(F.size("have") > 1)  # at most one entry for each collection
            .select("rep", "n", F.explode("have").alias("v")).select("rep", "n", "v.*"), "values")
        # of the values that many sets hold, those whose sets mostly agree in a second one, too
        held, squares = F.sum("m").cast("double"), F.sum(F.col("m").cast("double") * F.col("m"))
        dense = (mine.filter(F.col("c") > _FEW).groupBy("i", "h", "next").agg(F.count("*").alias("m"))
                 .groupBy("i", "h").agg((_DENSE * squares >= held * held).alias("dense"))
                 .filter("dense"))
        marked = self.stage.put(
            mine.join(dense, ["i", "h"], "left")
            .withColumn("whole", (F.col("c") <= _FEW) | F.coalesce("dense", F.lit(False)))
            .select("rep", "n", "i", "h", "whole"), "marked-values")
        self.stage.drop(shared, mine)
        pairs = F.expr(
            "flatten(transform(have, (x, k) -> transform(slice(have, k + 2, size(have)),"
            " y -> xxhash64(x.i, y.i, x.h, y.h))))")
        split = (marked.filter("NOT whole").groupBy("rep", "n")
                 .agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("have"))
                 .select("rep", "n", F.explode(pairs).alias("key")))
        keys = self.stage.put(marked.filter("whole").select(
            "rep", "n", F.xxhash64("i", "h").alias("key")).unionByName(split), "keys")
        self.stage.drop(marked)
        return keys

    def _distinct_buckets(self, members: DataFrame, *aggregates) -> DataFrame:
        """``key`` and ``aggregates`` of one bucket for each set of members."""
        marks = [F.count("*").alias("m0")] + [
            F.sum(F.xxhash64("rep", F.lit(i)).cast("decimal(38,0)")).alias(f"m{i}") for i in (1, 2)]
        each = members.groupBy("key").agg(*aggregates, *marks)
        names = each.columns[1:-3]
        return (each.groupBy("m0", "m1", "m2").agg(F.min(F.struct("key", *names)).alias("one"))
                .select("one.*"))

    def _plausible(self, n_a: str, n_b: str):
        """Sizes alone do not rule the link out."""
        return (100 * F.least(n_a, n_b)) >= (self.percent * F.greatest(n_a, n_b))

    def _whole_sets(self, buckets: DataFrame, reps: DataFrame) -> DataFrame:
        """``rep, shingles, odd`` of the sets in any bucket."""
        wanted = self.stage.put(buckets.select("rep").distinct().join(
            reps.select("rep", "first_id", "digest"), "rep"), "wanted")
        docs = likely(self.docs, ["doc_id"], wanted, ["first_id"])
        texts = docs.join(wanted, docs["doc_id"] == wanted["first_id"]).select(
            "rep", "digest", "text")
        sets = self.stage.put(texts.mapInArrow(
            _full_sets(self.size), "rep long, shingles array<long>, odd array<long>"), "sets")
        self.stage.drop(wanted)
        return sets

    def _slack(self, sets: DataFrame) -> DataFrame:
        """``rep, slack``: two sets whose slacks add up to less than 0 are no link."""
        own = (sets.select("rep", F.explode("shingles").alias("s")).groupBy("s")
               .agg(F.count("*").alias("c"), F.min("rep").alias("rep")).filter("c = 1")
               .groupBy("rep").agg(F.count("*").alias("own")))
        return sets.select("rep", F.size("shingles").alias("n")).distinct().join(
            own, "rep", "left").select("rep", (
                (100 - self.percent) * F.col("n").cast("long")
                - (100 + self.percent) * F.coalesce("own", F.lit(0))).alias("slack"))

    def _may_link(self):
        """The odd sketches allow a link between ``n, odd`` and ``na, oa``."""
        differing = sum(F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("oa")[i]))
                        for i in range(_ODD_WORDS))
        return (100 + self.percent) * differing <= (100 - self.percent) * (F.col("n") + F.col("na"))

    def _verify(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The links among ``a, b`` pairs, confirmed on the full sets."""
        pairs = self.stage.put(pairs.distinct(), "met")
        ends = self.stage.put(
            pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "ends")
        sets = sets.select("rep", "shingles").join(ends, "rep", "left_semi")
        common = F.size(F.array_intersect("sa", "sb"))
        links = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
                 .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
                 .withColumn("common", common)
                 .filter(100 * F.col("common") >= self.percent
                         * (F.size("sa") + F.size("sb") - F.col("common"))))
        out = self.stage.put(links.select("a", "b"), "links")
        self.stage.drop(pairs, ends)
        return out

    def _merge(self, roots: DataFrame, found: DataFrame) -> DataFrame:
        """``roots`` after more links: only the linked components are connected anew."""
        new = (found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
               .join(roots, "node", "left_anti"))
        nodes = self.stage.put(
            roots.unionByName(new.withColumn("root", F.col("node"))), "nodes")
        between = (found.join(nodes.toDF("a", "ra"), "a").join(nodes.toDF("b", "rb"), "b")
                   .select("ra", "rb"))
        merged = components(self.stage, between, "ra", "rb").toDF("root", "top")
        return self.stage.put(nodes.join(merged, "root", "left").select(
            "node", F.coalesce("top", "root").alias("root")), "roots")

    def run(self) -> tuple[DataFrame, DataFrame]:
        stage = self.stage
        hashed = self.docs.withColumn("text_hash", F.xxhash64("text"))
        sketches = stage.put(hashed.mapInArrow(
            _sketch(self.size, self.collections, self.rows),
            "doc_id long, text_hash long, n_shingles long, digest binary, vals array<long>"),
            "sketches")
        reps = (sketches.filter("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest")
                .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
                     F.first("vals").alias("vals")))
        reps = stage.put(reps.withColumn("rep", F.monotonically_increasing_id()), "sets")

        keys = self._keys(reps)
        sizes = self._distinct_buckets(keys, F.count("*").alias("c")).filter("c > 1")
        shared = stage.put(keys.join(sizes.select("key"), "key"), "shared-keys")
        stage.drop(keys)
        sets = self._whole_sets(shared, reps)
        # rows that share id and text have one set
        odd = stage.put(sets.select("rep", "odd").dropDuplicates(["rep"]), "odd-sketches")
        slack = stage.put(self._slack(sets), "slack")
        rest = stage.put(shared.join(slack, "rep"), "buckets")
        stage.drop(shared, slack)

        links = self.spark.createDataFrame([], "a long, b long")
        roots = self.spark.createDataFrame([], "node long, root long")
        spread, before = 1, [rest]
        while True:
            # members that were no pivot yet; each was compared with all pivots of its bucket
            members = stage.put(
                rest.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
                    "key", "rep", "n", "slack", F.coalesce("root", "rep").alias("root")), "members")
            still = (self._distinct_buckets(members, F.min("root").alias("x"),
                                            F.max("root").alias("y"), F.max("slack").alias("top"))
                     .filter("x <> y").select("key", "top"))
            stage.drop(*before)  # the tables that the last round left
            rest = stage.put(members.join(still, "key").filter("slack + top >= 0").drop("top"),
                             "unconnected")
            stage.drop(members)
            # the next pivots: of each of `spread` shares of a bucket the one with the most slack
            share = F.pmod(F.xxhash64("rep"), F.lit(spread))
            pivots = stage.put(
                rest.groupBy("key", share.alias("share"))
                .agg(F.min(F.struct((-F.col("slack")).alias("less"), "rep", "n", "root")).alias("p"))
                .select("key", F.col("p.rep").alias("a"), F.col("p.n").alias("na"),
                        F.col("p.root").alias("ra"), (-F.col("p.less")).alias("sa")), "pivots")
            if pivots.isEmpty():
                break
            pairs = (rest.join(odd, "rep").join(pivots.join(odd.toDF("a", "oa"), "a"), "key")
                     .filter((F.col("root") != F.col("ra")) & self._plausible("n", "na")
                             & (F.col("slack") + F.col("sa") >= 0) & self._may_link())
                     .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")))
            found = self._verify(pairs, sets)
            if not found.isEmpty():
                links = links.unionByName(found)
                roots = self._merge(roots, found)
            before = [rest, pivots]
            used = pivots.select("key", F.col("a").alias("rep"))
            rest = rest.join(used, ["key", "rep"], "left_anti").drop("root")
            spread *= 512

        named = roots.join(reps.select(F.col("rep").alias("node"), "first_id"), "node")
        smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        classes = stage.put(
            reps.select("rep", "digest", "first_id")
            .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .join(smallest, "root", "left")
            .select("digest", F.coalesce("component_id", "first_id").alias("component_id")),
            "classes")
        rows = sketches.select("doc_id", "text_hash", "n_shingles", "digest").join(
            classes, "digest", "left").select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
            .alias("component_id"), "text_hash")
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
        rows = rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash")
        ids = reps.select("rep", "first_id")
        named_links = (links.join(ids.toDF("a", "doc_a"), "a").join(ids.toDF("b", "doc_b"), "b")
                       .select("doc_a", "doc_b"))
        return rows, named_links


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5, collections: int = 16,
                    rows: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``: ``doc_id, n_shingles, component_id, kept, text_hash`` for every row
    (the hash tells rows apart that share an id), and confirmed links between the smallest ids of equal sets. Two sets are linked when
    ``100 * common >= percent * union``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _Dedup(texts, percent, shingle, collections, rows).run()
