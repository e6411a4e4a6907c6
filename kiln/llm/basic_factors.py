"""Periodic runs of words, by the dictionary of basic factors.

A run is a stretch of consecutive words of smallest period ``q``, at least
``max(min_length, min_exponent * q)`` words long, that no neighbouring word extends keeping
the period. The dictionary names, for every power of two, the factors of that length: a
factor is the pair of names of its halves. Where the next occurrence of a factor lies within
twice its length, the distance is a proposal for a period; consecutive positions with the
same distance are an arithmetic progression. Progressions are extended word by word to both
sides as far as the period holds, proposals that give the same stretch are made one, and
stretches with a smaller period go. A run of period ``q`` is met at the level with
``q <= 2**level < 2q``, where the factor's occurrences inside the run lie exactly ``q`` apart.

Positions whose factor occurs once in its document leave the dictionary, since every longer
factor there occurs once too; all documents of a batch are named together. Every document
is worked on by one task, without a shuffle; memory is that of the batch's words.

Defined results: a null or empty text has no words and no runs; ids play no part, so null
ids, repeated rows and further columns change nothing and are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Columns that the operator adds.
RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
         T.StructField("collapsed", T.StringType())]


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8, separated by any of space and 09 to 0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct key, and which positions share theirs with another."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    group = np.cumsum(new) - 1
    names = np.empty(len(keys), np.int64)
    names[order] = group
    return names, np.bincount(group, minlength=1)[names] > 1


def _progressions(pos: np.ndarray, names: np.ndarray, size: int, min_length: int,
                  min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(first position, positions, distance) of the progressions of successors within twice
    ``size`` whose factors together are as long as a run."""
    order = np.argsort(names, kind="stable")  # positions ascend within a name
    a, b = order[:-1], order[1:]
    step = pos[b] - pos[a]
    near = (names[a] == names[b]) & (step <= 2 * size)
    at, step = pos[a[near]], step[near]
    if not len(at):
        return
    back = np.argsort(at, kind="stable")
    at, step = at[back], step[back]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(step) != 0)) + 1
    first = np.concatenate([[0], cut])
    count = np.diff(np.concatenate([first, [len(at)]]))
    q = step[first]
    for i in np.flatnonzero(count + size - 1 + q >= np.maximum(min_length, min_exponent * q)):
        yield int(at[first[i]]), int(count[i]), int(q[i])


def _extend(ids: np.ndarray, lo: int, hi: int, start: int, end: int, q: int) -> tuple[int, int]:
    """The longest stretch around [start, end) within [lo, hi) that keeps period ``q``."""
    while start > lo:  # blocks of growing length, so that long stretches take few steps
        block = min(max(64, end - start), start - lo)
        same = ids[start - block:start] == ids[start - block + q:start + q]
        bad = np.flatnonzero(~same)
        if len(bad):
            start -= block - 1 - int(bad[-1])
            break
        start -= block
    while end < hi:
        block = min(max(64, end - start), hi - end)
        same = ids[end:end + block] == ids[end - q:end + block - q]
        bad = np.flatnonzero(~same)
        if len(bad):
            end += int(bad[0])
            break
        end += block
    return start, end


def find_runs(ids: np.ndarray, offsets: np.ndarray, min_length: int = 6,
              min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of every document, by start and period.

    ``ids`` are the word numbers of all documents, one after the other; document ``d`` is
    ``ids[offsets[d]:offsets[d + 1]]``."""
    if min_exponent < 3:  # a run must hold a factor of its level and the next occurrence
        raise ValueError("min_exponent must be at least 3")
    n_docs, n = len(offsets) - 1, len(ids)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n_docs)]
    if not n:
        return runs
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(n_docs), sizes)
    end_of = offsets[1:][doc]
    found: list[dict] = [{} for _ in range(n_docs)]
    name = np.full(n, -1, np.int64)
    pos, (got, twin) = np.arange(n), _names(doc * (int(ids.max()) + 1) + ids)
    longest = int(sizes.max())
    size = 1
    while True:
        pos, got = pos[twin], got[twin]
        for first, count, q in _progressions(pos, got, size, min_length, min_exponent):
            d = int(doc[first])
            lo, hi = int(offsets[d]), int(offsets[d + 1])
            start, end = _extend(ids, lo, hi, first, first + count - 1 + size + q, q)
            if end - start >= max(min_length, min_exponent * q):
                found[d].setdefault((start - lo, end - start), set()).add(q)
        # levels beyond this have no period that a document is long enough for
        if not len(pos) or min_exponent * (size + 1) > longest:
            break
        name[pos] = got
        pos = pos[pos + 2 * size <= end_of[pos]]
        pos = pos[name[pos + size] >= 0]
        if not len(pos):
            break
        keys = name[pos] * (int(got.max()) + 1) + name[pos + size]
        name[:] = -1
        got, twin = _names(keys)
        size *= 2
    for d, stretches in enumerate(found):
        # a stretch of several periods has the smallest, which divides the others
        runs[d] = sorted(((s, length, min(qs)) for (s, length), qs in stretches.items()),
                         key=lambda r: (r[0], r[2]))
    return runs


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(depth)) if not gone]


#: Bytes of text that are named together at most, but for a single longer text.
BATCH_BYTES = 4 << 20


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= BATCH_BYTES:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = 6,
                  min_exponent: int = 4) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``, the text's words without the
    repetitions of any run, joined by one space. Clashing columns of ``docs`` are replaced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                   ("period", pa.int64())]))
        for b in batches:
            texts = b.column(text).to_pylist()
            n_words, found, collapsed = [], [], []
            for lo, hi in _groups(texts):
                words = [words_of(t) for t in texts[lo:hi]]
                sizes = [len(w) for w in words]
                flat = pa.array([w for ws in words for w in ws], pa.binary())
                ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                runs = find_runs(ids, offsets, min_length, min_exponent)
                n_words += sizes
                found += [[{"start": s, "length": n, "period": q} for s, n, q in r]
                          for r in runs]
                collapsed += [b" ".join(kept_words(w, r)).decode("utf-8", "surrogatepass")
                              for w, r in zip(words, runs)]
            kept = [c for c in b.schema.names if c not in ("n_words", "runs", "collapsed")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(n_words, pa.int64()),
                                               pa.array(found, kind),
                                               pa.array(collapsed, pa.string())],
                kept + ["n_words", "runs", "collapsed"])
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "runs", "collapsed")]
    return docs.mapInArrow(run, T.StructType(kept + ADDED))
