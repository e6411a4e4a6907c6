"""Best-fit decreasing packing of token pieces into fixed-size sequences.

A document's ids (tokenizer ids, then the end id) are cut into pieces of ``capacity``
only when they are longer. Best-fit decreasing treats pieces of one length alike and open
bins of one remaining capacity alike, so it is run on the histogram of piece lengths: at
most ``capacity`` rows, however many documents there are. A segment tree over the
remaining capacities finds the tightest open bins for a length in logarithmic time, and
whole runs of equal pieces go into runs of equal bins at once. The result is the packing
that best-fit decreasing gives piece by piece.

Every placement of the plan covers a range of ranks of one length; pieces are ranked
within their length in two levels (hash bucket, then inside the bucket), so a length that
a third of all pieces share never meets in one task, and each piece looks its rank up in
the plan. Only the histogram and the plan (both bounded by ``capacity``) pass the driver.

Defined results: null text is the empty text, which gives one piece holding the end id;
repeated rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.memory import give_back, gives_back
from kiln.llm.store import Stage


class CapacityTree:
    """Segment tree over remaining capacities 0..size; counts the open bins of each."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        at = self.leaves + remaining
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, needed: int) -> int | None:
        """The smallest remaining capacity >= needed that an open bin has."""
        at = self.leaves + needed
        if self.count[at]:
            return needed
        while at > 1:  # climb to the first right sibling that holds bins, then descend left
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements ``(length, first rank, count, first sequence, offset)`` of best-fit
    decreasing: piece ``first rank + i`` goes to sequence ``first sequence + i``."""
    tree, out, sequences = CapacityTree(capacity), [], 0
    open_runs: dict[int, list[tuple[int, int]]] = {}  # remaining -> runs (first sequence, bins)

    def place(length: int, rank: int, first: int, bins: int, remaining: int) -> None:
        out.append((length, rank, bins, first, capacity - remaining))
        left = remaining - length
        if left:
            open_runs.setdefault(left, []).append((first, bins))
            tree.add(left, bins)

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            remaining = tree.tightest(length)
            if remaining is None:
                # one new bin holds several of these; the extra ones are found by best fit
                bins = -(-todo // (capacity // length))
                place(length, rank, sequences, bins, capacity)
                sequences += bins
            else:
                first, have = open_runs[remaining].pop()
                bins = min(have, todo)
                tree.add(remaining, -bins)
                if bins < have:
                    open_runs[remaining].append((first + bins, have - bins))
                    tree.add(remaining, 0)
                place(length, rank, first, bins, remaining)
            rank += bins
            todo -= bins
    return out


# How the tokenizer cuts a lower-case word of Latin-1 characters into parts that
# are encoded by themselves; its \s matches 85 and A0 besides what words are split at.
_LETTERS = r"a-z\x{aa}\x{b5}\x{ba}\x{df}-\x{f6}\x{f8}-\x{ff}"
_NUMBERS = r"0-9\x{b2}\x{b3}\x{b9}\x{bc}-\x{be}"
_PARTS = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ {_NUMBERS}{_LETTERS}]+"
_LATIN_WHITE = r"[\x{85}\x{a0}]+"
#: Words with characters beyond Latin-1, or with what may be a special token, are left whole.
_WHOLE = r"[^\x{00}-\x{ff}]|<\|"


def _gather(flat: np.ndarray, starts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The stretches ``flat[starts[i]:starts[i + 1]]`` of all ``index``, one after the other."""
    size = starts[index + 1] - starts[index]
    first = np.repeat(starts[index] - (np.cumsum(size) - size), size)
    return flat[first + np.arange(len(first))]


class Encoder:
    """Token ids by a tokenizer whose pre-tokenizer never crosses white space.

    Arrow splits a batch into words, numbers the distinct ones, cuts these into parts and numbers
    the distinct parts; only parts that are not remembered are encoded, and ids are gathered by
    number. The memory of parts is bounded in bytes, entry by entry, whatever a worker reads."""

    #: Bytes an entry takes: dictionary slot, string, ids.
    ENTRY = 160
    #: Distinct words that are cut and looked up together.
    BLOCK = 400_000
    #: A character that is a token of its own, and how many parts it keeps apart in a text.
    MARK, JOINED = "~", 200

    def __init__(self, path: str, remember_bytes: int = 64 << 20):
        # Spark's tasks are the parallel work; threads of its own would only take memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.remember_bytes = remember_bytes
        # part -> its ids; parts that were not met since the memory was last half full go first
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _keep(self, fresh: dict[str, bytes]) -> None:
        for part, ids in fresh.items():
            self.held += self.ENTRY + len(part) + len(ids)
            if 2 * self.held > self.remember_bytes:
                self.old, self.young, self.held = self.young, {}, 0
            self.young[part] = ids

    def _encode(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of parts by the tokenizer: many parts in a text, with a mark between them that
        none of them holds; the others by themselves."""
        mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        alone, joined = [], []
        for p in parts:
            plain = p and self.MARK not in p and "<" not in p and (p.isascii() or max(p) <= "\xff")
            (joined if plain and len(mark) == 1 else alone).append(p)
        groups = [joined[i:i + self.JOINED] for i in range(0, len(joined), self.JOINED)]
        for lo in range(0, len(groups), 100):
            some = groups[lo:lo + 100]
            texts = [f" {self.MARK} ".join(g) for g in some]
            for group, e in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, np.uint32)
                cuts = np.flatnonzero(ids == mark[0])
                if len(cuts) != len(group) - 1:
                    alone += group
                    continue
                raw, at = ids.tobytes(), 0
                for part, cut in zip(group, [*cuts.tolist(), len(ids)]):
                    yield part, raw[4 * at:4 * cut]
                    at = cut + 1
        for lo in range(0, len(alone), 10_000):
            some = alone[lo:lo + 10_000]
            for part, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                yield part, array("I", e.ids).tobytes()

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts."""
        out = list(map(self.young.get, parts))
        at = [i for i, ids in enumerate(out) if ids is None]
        again = [(i, self.old.get(parts[i])) for i in at]
        new = [i for i, ids in again if ids is None]
        fresh = {parts[i]: ids for i, ids in again if ids is not None}
        fresh.update(self._encode([parts[i] for i in new]))
        for i in at:
            out[i] = fresh[parts[i]]
        self._keep(fresh)
        return out

    def _of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words``, one after the other, and where each word's begin."""
        ids, sizes = [], []
        for lo in range(0, len(words), self.BLOCK):
            block = words.slice(lo, self.BLOCK)
            cut = pc.replace_substring_regex(pc.utf8_lower(block), _LATIN_WHITE, " ")
            cut = pc.replace_substring_regex(cut, _PARTS, r"\0 ")
            lists = pc.ascii_split_whitespace(
                pc.if_else(pc.match_substring_regex(block, _WHOLE), block, cut))
            parts = lists.flatten().dictionary_encode()
            known = self._ids_of(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
            starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, known), np.int64) // 4)])
            index = parts.indices.to_numpy()
            ids.append(_gather(np.frombuffer(b"".join(known), np.uint32), starts, index))
            ends = np.concatenate([[0], np.cumsum(starts[index + 1] - starts[index])])
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sizes.append(np.diff(ends[offsets]))
        if not ids:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        ids, starts = self._of_words(words.dictionary)
        number = words.indices.to_numpy()
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        for lo, hi in zip(offsets[:-1], offsets[1:]):
            # a very long text needs no array of numbers of its length
            blocks = [_gather(ids, starts, number[at:min(hi, at + (1 << 18))])
                      for at in range(lo, hi, 1 << 18)]
            yield np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)


_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


#: Characters of text that are encoded together at most, but for a single longer text.
TEXT_AT_ONCE = 1 << 20

#: Characters of text after which a worker returns what it has freed.
GIVE_BACK = 16 << 20


def _slices(texts: pa.Array, at_once: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows, by the bytes of their texts."""
    sizes = pc.binary_length(texts).to_numpy()
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and held + n > at_once:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker process: loaded and taught once, bounded for good."""
    return Encoder(path)


def _cut(tokenizer_path: str, capacity: int, end_id: int, at_once: int):
    @gives_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what the worker's earlier tasks left
        encoder, read = _encoder(tokenizer_path), 0
        for whole in batches:
            for lo, hi in _slices(whole.column(1), at_once):
                batch = whole.slice(lo, hi - lo)
                read += pc.sum(pc.binary_length(batch.column(1))).as_py()
                if read > GIVE_BACK:
                    give_back()
                    read = 0
                rows: list[tuple] = []
                for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start:start + capacity]
                        rows.append((doc, n, start, len(piece), zlib.crc32(piece)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return cut


def _look_up(placements: list[tuple[int, int, int, int, int]]):
    """Sequence and offset by (length, rank): placements sorted by (length, first rank)."""
    rows = np.array(sorted((p[0], p[1], p[3], p[4]) for p in placements),
                    dtype=np.int64).reshape(-1, 4)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_of = {int(n): i for i, n in reversed(list(enumerate(rows[:, 0])))}
        last_of = {int(n): i + 1 for i, n in enumerate(rows[:, 0])}
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for n in np.unique(length):
                lo, hi = first_of[int(n)], last_of[int(n)]
                here = length == n
                at[here] = lo + np.searchsorted(rows[lo:hi, 1], rank[here], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(rows[at, 2] + rank - rows[at, 1]), pa.array(rows[at, 3])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return look_up


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", rank_bucket: int = 50_000,
         text_at_once: int = TEXT_AT_ONCE) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    stage = Stage(spark, "pack")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = stage.put(texts.mapInArrow(_cut(tokenizer_path, capacity, end_id, text_at_once),
                                        _PIECES), "pieces")
    # Bounded by capacity: one row per length.
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placements = plan(histogram, capacity)
    buckets = max(1, -(-sum(histogram.values()) // rank_bucket))
    # Rank within a length: rank inside (length, bucket) plus the sizes of earlier buckets.
    spread = pieces.withColumn("bucket", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket")
    firsts = (spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .withColumn("first", F.sum("n").over(before) - F.col("n")).drop("n"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (spread.withColumn("rank", F.row_number().over(inside) - 1)
              .join(firsts, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("first")))
    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(_look_up(placements), _PIECES + ", sequence_id long, offset long"))
