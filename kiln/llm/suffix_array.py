"""Substring dedup of bytes by the interval tree of an enhanced suffix array.

Suffixes that start at seeds (see ``seeds``) are sorted by the bytes that follow, many
grams at a time, with the lengths of the common prefixes of neighbours: an enhanced suffix
array. One scan with a stack walks its common-prefix intervals, the internal nodes of the
suffix tree. All members of an interval of depth d share d bytes to the right of the seed;
left extension is tested among all of them, not just neighbours: members are ordered by
the bytes before the seed, read backwards, and each learns the longest stretch that it
shares with any other member. Where stretches differ the interval is left-diverse and a
maximal repeat; where they agree the repeat reaches further left by that much. A member
whose shared bytes before and after the seed make ``window`` bytes or more is a repeat,
and its whole extent is covered.

Every string of ``window`` bytes that starts in two places is removed in all of them, in
one document or several; strings never cross documents and are judged on the input.

Defined results: a null text has no bytes; texts are UTF-8; repeated rows are documents of
their own, so their texts of ``window`` bytes and more are removed. Grams with more than
``max_group`` different contexts are solved by the same array after grouping them by longer
strings (see ``seeds``); groups that are still larger by aggregating their windows instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.seeds import RepeatFinder, Units, Unpacker
from kiln.llm.suffix_tree import merged, whole_text


def _padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8)
    return flat.reshape(len(parts), width), sizes


def _common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the next."""
    if len(rows) < 2:
        return np.zeros(0, np.int64)
    differs = rows[1:] != rows[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, last)`` of the common-prefix intervals of depth ``least`` or more;
    ``lcp[i]`` belongs to entries i and i + 1. Inner intervals come before outer ones."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp.tolist(), 0]):
        first = i
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            yield inner, first, i
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def solve_intervals(units: Units, gram, context, copies, first_doc, before, raw) -> list:
    """For every context: how far repeats that hold the seed reach before and after it."""
    lefts = [b[:k][::-1] for b, k in zip(raw, before)]
    rights = [b[k:] for b, k in zip(raw, before)]
    n = len(raw)
    reach_left, reach_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # several copies of one context cover it whole
    size_left = np.array([len(x) for x in lefts], np.int64)
    size_right = np.array([len(x) for x in rights], np.int64)
    whole = (copies > 1) & (size_left + size_right >= units.window)
    reach_left[whole], reach_right[whole] = size_left[whole], size_right[whole]

    order = np.array(sorted(range(n), key=lambda i: (gram[i], rights[i])), np.int64)
    rows, sizes = _padded([rights[i] for i in order], units.window)
    lcp = _common(rows, sizes)
    lcp[gram[order][1:] != gram[order][:-1]] = 0
    before_rows, before_sizes = _padded(lefts, max(1, units.left))
    by_left = np.empty(n, np.int64)
    by_left[sorted(range(n), key=lefts.__getitem__)] = np.arange(n)

    for depth, first, last in intervals(lcp, units.gram):
        if depth + units.left < units.window:
            continue
        members = order[first:last + 1]
        members = members[np.argsort(by_left[members])]
        shared = _common(before_rows[members], before_sizes[members])
        most = np.maximum(np.r_[shared, 0], np.r_[0, shared])  # with any other member
        long = most + depth >= units.window
        hit = members[long]
        reach_left[hit] = np.maximum(reach_left[hit], most[long])
        reach_right[hit] = np.maximum(reach_right[hit], depth)
    found = reach_right > 0
    return [gram[found], context[found], reach_left[found], reach_right[found]]


def repeated_bytes(docs: DataFrame, window: int = 200, gram: int = 32, max_group: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text",
                   with_rest: bool = False) -> DataFrame:
    """``doc_id, rest, packed, spans`` for every row: the zstd-compressed text and the
    stretches (start, end) of bytes to remove, which may overlap; with ``with_rest`` the
    struct ``rest`` holds the other columns."""
    units = Units(words=False, window=window, gram=gram)
    finder = RepeatFinder(docs, units, id_col, text_col, "suffix-array", with_rest)
    firsts, copies = finder.copies()
    occurrences = finder.occurrences(firsts)
    contexts = finder.contexts(occurrences)

    def by_window(rows: DataFrame) -> DataFrame:
        windows = finder.stage.put(finder.window_rows(rows), "windows")
        # a window that holds several seeds is in the contexts of each: count it per seed
        key = ["window", "gram", "back"]
        twice = windows.groupBy(*key).agg(F.sum("copies").alias("n")).filter("n > 1")
        return (windows.join(finder.stage.put(twice.select(*key), "twice"), key)
                .groupBy(F.col("of").alias("gram"), "context").agg(
                    F.max("back").cast("long").alias("reach_left"),
                    F.max(F.lit(window) - F.col("back")).cast("long").alias("reach_right")))

    solved = finder.solve(contexts, solve_intervals,
                          "gram long, context long, reach_left long, reach_right long",
                          by_window, max_group, in_halves=True)
    copied = contexts.filter((F.col("copies") > 1)
                             & (F.col("before") + F.col("after") >= window)).select(
        "gram", "context", F.col("before").cast("long").alias("reach_left"),
        F.col("after").cast("long").alias("reach_right"))
    reach = solved.unionByName(copied).groupBy("gram", "context").agg(
        F.max("reach_left").alias("reach_left"), F.max("reach_right").alias("reach_right"))
    reach = finder.stage.put(reach, "reach")
    finder.stage.drop(contexts)
    spans = (occurrences.join(reach, ["gram", "context"])
             .select("doc", (F.col("at") - F.col("reach_left")).cast("int").alias("start"),
                     (F.col("at") + F.col("reach_right")).cast("int").alias("end"))
             .groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    spans = finder.stage.put(spans, "spans")
    finder.stage.drop(occurrences, reach)
    # every string of a text that has copies starts in another one as well
    whole = copies.select("doc", F.lit(True).alias("whole"))
    return finder.texts.join(spans, "doc", "left").join(whole, "doc", "left").select(
        "doc_id", "rest", "packed",
        F.when(F.col("whole"), F.array(F.struct(F.lit(0).alias("start"), F.lit(-window).alias("end"))))
        .otherwise(F.col("spans")).alias("spans"))


def kept_bytes(packed: bytes | None, spans: list[dict] | None,
               unpack: Unpacker) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed stretches, and the bytes that stay."""
    raw = unpack(packed)
    gone = merged(whole_text(spans, len(raw)))
    at, kept = 0, []
    for start, end in gone:
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return len(raw), sum(b - a for a, b in gone), len(gone), b"".join(kept)
