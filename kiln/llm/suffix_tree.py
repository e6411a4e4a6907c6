"""Substring dedup of word sequences by prefix-partitioned suffix trees.

Suffixes that start at seeds (see ``seeds``) are partitioned by their first words: the
seed's gram. A partition whose different contexts would not fit the memory bound is taken
apart by longer prefixes, whole windows, and aggregated. Each partition's subtree is built
level by level: the nodes of depth d are the classes of suffixes that share d words. A
window that starts ``back`` words before the seed is repeated where a node of depth
``window - back`` holds suffixes that also share the ``back`` words before the seed: these
are the deep nodes, and the smallest document below each is kept.

A word is removed when a window over it also starts in a document with a smaller id.
Windows are judged on the input.

Defined results: null and word-less texts have no words; a null id comes after all others
(its windows never remove another's, any document's remove its); rows that share an id do
not remove each other's words; repeated rows get equal results; texts are kept as they are
where nothing is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.minhash import _scramble
from kiln.llm.seeds import LAST, RepeatFinder, Units, Unpacker


def subtree_classes(units: Units, gram, context, copies, first_doc, before, raw) -> list:
    """For every context and every ``back``: the smallest document of the node's class."""
    n, left, window = len(raw), units.left, units.window
    # words by distance from the seed, with 0 (never a word here) where the document ends
    after = np.zeros((n, window), np.uint64)
    ahead = np.zeros((n, left), np.uint64)
    n_after = np.empty(n, np.int64)
    for i, b in enumerate(raw):
        words = np.frombuffer(b, np.uint64)
        at = int(before[i])
        n_after[i] = len(words) - at
        after[i, :len(words) - at] = words[at:]
        ahead[i, :at] = words[:at][::-1]
    # node of each depth: the label of the path, from the partition's gram downwards
    nodes = [_scramble(gram.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))]
    for d in range(window):
        nodes.append(_scramble(nodes[-1] * np.uint64(0x9E3779B97F4A7C15) + after[:, d]))
    best = np.full((n, left + 1), LAST, np.int64)
    share = np.zeros(n, np.uint64)  # label of the words before the seed
    for back in range(left + 1):
        if back:
            share = _scramble(share * np.uint64(0xA0761D6478BD642F) + ahead[:, back - 1])
        whole = np.flatnonzero((before >= back) & (n_after >= window - back))
        if not len(whole):
            continue
        label = _scramble(nodes[window - back][whole] ^ (share[whole] + np.uint64(back)))
        _, node = np.unique(label, return_inverse=True)
        smallest = np.full(node.max() + 1, LAST, np.int64)
        np.minimum.at(smallest, node, first_doc[whole])
        best[whole, back] = smallest[node]
    values = pa.array(best.ravel(), pa.int64())
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * (left + 1), pa.int32()), values)
    return [gram, context, lists]


def _window_spans(units: Units):
    """Removed stretches of words of each occurrence."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, starts, ends = [], [], []
            own = b.column("doc_id").to_pylist()
            for doc, doc_id, at, before, after, firsts in zip(
                    b.column("doc").to_pylist(), own, b.column("at").to_pylist(),
                    b.column("before").to_pylist(), b.column("after").to_pylist(),
                    b.column("firsts").to_pylist()):
                mine = LAST if doc_id is None else doc_id
                start = end = None
                for back in range(min(before, units.left), -1, -1):
                    if after >= units.window - back and firsts[back] < mine:
                        lo = at - back
                        if end is not None and lo <= end:
                            end = lo + units.window
                        else:
                            if end is not None:
                                docs.append(doc)
                                starts.append(start)
                                ends.append(end)
                            start, end = lo, lo + units.window
                if end is not None:
                    docs.append(doc)
                    starts.append(start)
                    ends.append(end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts, pa.int32()),
                 pa.array(ends, pa.int32())], ["doc", "start", "end"])
    return work


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal stretches covered by (start, end) spans."""
    out: list[list[int]] = []
    for s in sorted((s["start"], s["end"]) for s in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append([s[0], s[1]])
    return [tuple(s) for s in out]


def repeated_words(docs: DataFrame, window: int = 13, gram: int = 5, max_group: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, packed, spans`` for every row: the zstd-compressed text and the stretches
    (start, end) of words to remove, which may overlap; ``kept_words`` reads them."""
    units = Units(words=True, window=window, gram=gram)
    finder = RepeatFinder(docs, units, id_col, text_col, "suffix-tree")
    firsts, copied = finder.copies()
    occurrences = finder.occurrences(firsts)
    contexts = finder.contexts(occurrences)
    n = units.left + 1

    def by_window(rows: DataFrame) -> DataFrame:
        windows = finder.stage.put(finder.window_rows(rows), "windows")
        least = finder.stage.put(windows.groupBy("window", "back").agg(
            F.min("first_doc").alias("least")), "least")
        per = windows.join(least, ["window", "back"]).groupBy("gram", "context").agg(
            F.map_from_entries(F.collect_set(F.struct("back", "least"))).alias("m"))
        return per.select("gram", "context", F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: F.coalesce(F.col("m")[i], F.lit(LAST))).alias("firsts"))

    solved = finder.solve(contexts, subtree_classes,
                          "gram long, context long, firsts array<long>", by_window, max_group)
    solved = finder.stage.put(solved.dropDuplicates(["gram", "context"]), "classes")
    # a gram with one context: all its copies are one class
    single = contexts.join(solved.select("gram").distinct(), "gram", "left_anti").filter("copies > 1")
    classes = solved.unionByName(single.select(
        "gram", "context", F.array_repeat("first_doc", n).alias("firsts")))
    spans = (occurrences.join(classes, ["gram", "context"])
             .select("doc", "doc_id", "at", "before", "after", "firsts")
             .mapInArrow(_window_spans(units), "doc long, start int, end int")
             .groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    spans = finder.stage.put(spans, "spans")
    finder.stage.drop(occurrences, contexts, solved)
    # a copy of a text that a smaller id has loses all its windows
    later = copied.filter("later").select("doc", F.lit(True).alias("later"))
    return finder.texts.join(spans, "doc", "left").join(later, "doc", "left").select(
        "doc_id", "packed",
        F.when(F.col("later"), F.array(F.struct(F.lit(0).alias("start"), F.lit(-window).alias("end"))))
        .otherwise(F.col("spans")).alias("spans"))


def whole_text(spans: list[dict] | None, units: int) -> list[dict] | None:
    """A span that ends at ``-window`` covers all of a text of a window or more."""
    if spans and spans[0]["end"] < 0:
        return [{"start": 0, "end": units}] if units >= -spans[0]["end"] else []
    return spans


def kept_words(packed: bytes | None, spans: list[dict] | None,
               unpack: Unpacker) -> tuple[int, int, list[bytes]]:
    """Words, removed words, and the words that stay, unchanged."""
    words = unpack(packed).split()
    kept, at, gone = [], 0, 0
    for start, end in merged(whole_text(spans, len(words))):
        kept += words[at:start]
        gone += end - start
        at = end
    return len(words), gone, kept + words[at:]
