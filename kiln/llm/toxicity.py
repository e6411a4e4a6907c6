"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Text is folded first: lower case, accents and full-width forms removed, look-alike letters
of other scripts and digits or signs inside words (``1d10t``, ``b4574rd``, ``tr@sh``) read as
the letters they stand for, everything else turned into one space. ``1`` and ``|`` stand for
``i`` and for ``l`` and match both. Where a word with signs has no entry, its other readings
are tried: all signs as letters, ``!`` and ``|`` as separators, all signs as separators.
Entries are word beginnings
(``idiot`` also finds ``idiots``); all are found in one pass. Matches that lie inside an
exception phrase (``trash can``) do not count. The score is a logistic function of the
weighted hits per word and of the number of weighted hits, so long texts are not toxic for
their length.

The lexicon starts from seed words and learns further entries and all weights from
labelled rows: at most ``max_rows`` of them, taken in hash order (the documented bound of
the fit). Scoring covers every row and whole texts; a score depends on the text alone.

Defined results: null and empty texts score as texts without hits; label rows with a null
id or label are not learned from; where no labelled row is toxic (or none is clean), the
seed words and fixed coefficients decide.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common insults the lexicon starts from.
SEEDS = ["idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "worthless", "pathetic",
         "disgusting", "clown", "imbecile", "bastard", "asshole", "bitch", "retard", "filth",
         "vermin", "shithead", "dickhead"]
# Harmless phrases that contain an entry.
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "trash collection", "clown fish",
              "clownfish", "class clown", "sore loser", "loser bracket", "pathetic fallacy",
              "dumbbell", "dumb waiter", "stupid question", "scum line", "pond scum"]
# Letters of other scripts that look like Latin ones (after lower-casing).
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "ɡ": "g", "н": "h",
    "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o",
    "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɩ": "i",
    "ɑ": "a", "ʀ": "r", "ɴ": "n", "ɪ": "i", "ʟ": "l", "ᴏ": "o", "ø": "o", "ł": "l", "đ": "d",
    "ð": "d", "ħ": "h", "ŧ": "t"}
# Digits and signs read as letters inside words.
EITHER = "ı"  # i or l; the folded text has no other dotless i
SIGNS = {"0": "o", "1": EITHER, "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": EITHER, "€": "e", "£": "l"}

_SIGN_SET = re.escape("".join(SIGNS))
_SIGN_RUN = re.compile(f"[{_SIGN_SET}]+")
# A word with signs: letters and signs, at least one sign; reads every character once.
_SIGNED = re.compile(rf"(?<![^\W\d_])(?<![{_SIGN_SET}])[^\W\d_]*+[{_SIGN_SET}]++"
                     rf"(?:[^\W\d_]|[{_SIGN_SET}])*+")
_BARS = re.compile("[!|]+")
_SIGN_TABLE = str.maketrans(SIGNS)
_GONE = re.compile(r"[̀-ͯ​-‏⁠﻿­]+")
_SPACE = re.compile(r"[\W\d_]+")
_LIKE_TABLE = str.maketrans(LOOKALIKES)


def _read_signs(m: re.Match) -> str:
    """Letters for a run of signs that a letter follows, and for a run of one or two at a
    word's end; longer runs there are junk."""
    text, start, end = m.string, m.start(), m.end()
    followed = end < len(text) and text[end].isalpha()
    behind = (start > 0 and text[start - 1].isalpha() and end - start <= 2
              and m[0][-1] not in "!|")
    return m[0].translate(_SIGN_TABLE) if followed or behind else m[0]


def _reader(known: Callable[[str], bool] | None):
    """Reads a word with signs: the usual reading, or the first one that has an entry."""
    def read(m: re.Match) -> str:
        word = m[0]
        usual = _SIGN_RUN.sub(_read_signs, word)
        if known is None or not any(map(str.isalpha, word)) or known(usual):
            return usual
        for other in (word.translate(_SIGN_TABLE), _BARS.sub(" ", word).translate(_SIGN_TABLE),
                      _SIGN_RUN.sub(" ", word)):
            if other != usual and known(other):
                return other
        return usual
    return read


_READ_USUAL = _reader(None)


def fold(text: str, read: Callable[[re.Match], str] = _READ_USUAL) -> str:
    """The folded text: letters and single spaces, a space at both ends."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = _GONE.sub("", text).translate(_LIKE_TABLE)
    text = _SIGNED.sub(read, text)
    return " " + _SPACE.sub(" ", text).strip(" ") + " "


def _skeleton(folded: str) -> str:
    """i, l and ``EITHER`` alike; candidates found in it are compared with ``_fits``."""
    return folded.replace("l", "i").replace(EITHER, "i")


def _fits(entry: str, piece: str) -> bool:
    return entry == piece or EITHER in piece and all(
        a == b or b == EITHER and a in "il" for a, b in zip(entry, piece))


def _automaton(entries: dict[str, object]):
    """Finds the skeletons of ``entries``; each gives its (entry, value) pairs."""
    import ahocorasick
    groups: dict[str, list] = {}
    for entry, value in entries.items():
        groups.setdefault(_skeleton(entry), []).append((entry, value))
    found = ahocorasick.Automaton()
    for key, group in groups.items():
        found.add_word(key, group)
    if len(found):
        found.make_automaton()
    return found


def _find(automaton, folded: str, skeleton: str) -> Iterator[tuple[int, int, object]]:
    """(start, last position, value) of every entry in a folded text."""
    if len(automaton):
        for end, group in automaton.iter(skeleton):
            for entry, value in group:
                start = end + 1 - len(entry)
                if _fits(entry, folded[start:end + 1]):
                    yield start, end, value


@dataclass
class Lexicon:
    """Weights of word beginnings and the coefficients of the score."""
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))
    coefficients: tuple[float, float, float] = (-4.0, 1.5, 1.5)

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.coefficients = lexicon.coefficients
        self.words = _automaton({" " + w: weight for w, weight in lexicon.weights.items()})
        self.phrases = _automaton({fold(p).rstrip(" "): None for p in lexicon.exceptions})
        self.read = _reader(self._known)

    def _known(self, reading: str) -> bool:
        folded = _SPACE.sub(" ", " " + reading)
        return any(True for _ in _find(self.words, folded, _skeleton(folded)))

    def features(self, text: str | None) -> tuple[float, float]:
        """log(1 + weighted hits per hundred words) and log(1 + weighted hits)."""
        folded = fold(text or "", self.read)
        skeleton = _skeleton(folded)
        hits: dict[int, float] = {}
        # by the space before the word: nested entries count once
        for start, _, weight in _find(self.words, folded, skeleton):
            hits[start] = max(hits.get(start, 0.0), weight)
        if hits:
            for start, end, _ in _find(self.phrases, folded, skeleton):
                if folded[end + 1:end + 2] in (" ", "s", ""):
                    for at in [h for h in hits if start <= h <= end]:
                        del hits[at]
        total = sum(hits.values())
        words = folded.count(" ") - 1
        return math.log1p(100.0 * total / (words + 1)), math.log1p(total)

    def score(self, text: str | None) -> float:
        return _logistic(self.coefficients, self.features(text))


def _logistic(c: tuple[float, float, float], x: tuple[float, float]) -> float:
    z = c[0] + c[1] * x[0] + c[2] * x[1]
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


_LONGEST, _SHORTEST = 10, 4


def _beginnings(text: str) -> Counter:
    """Occurrences of each word beginning in a folded text."""
    out: Counter = Counter()
    for word, n in Counter(fold(text).replace(EITHER, "i").split()).items():
        for size in range(_SHORTEST, min(len(word), _LONGEST) + 1):
            out[word[:size]] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of word beginnings by label: documents and occurrences."""
    toxic_docs: Counter = Counter()
    toxic_hits: Counter = Counter()
    clean_docs: Counter = Counter()
    clean_hits: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist()):
            found = _beginnings(text)
            (toxic_hits if toxic else clean_hits).update(found)
            (toxic_docs if toxic else clean_docs).update(found.keys())
    keys = list(toxic_docs.keys() | clean_docs.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()),
         *(pa.array([c[k] for k in keys], pa.int64())
           for c in (toxic_docs, clean_docs, toxic_hits, clean_hits))],
        ["entry", "toxic_docs", "clean_docs", "toxic_hits", "clean_hits"])


def _choose(rows: list, n_toxic: int, n_clean: int, words_toxic: int, words_clean: int,
            seeds: list[str], max_entries: int) -> dict[str, float]:
    """Weights by the ratio of rates in toxic and clean rows; of nested beginnings the one
    with the most evidence stays."""
    scored = {}
    for r in rows:
        rate = math.log(((r["toxic_hits"] + 0.5) / (words_toxic + 1.0))
                        / ((r["clean_hits"] + 0.5) / (words_clean + 1.0)))
        docs = math.log(((r["toxic_docs"] + 0.5) / (n_toxic + 1.0))
                        / ((r["clean_docs"] + 0.5) / (n_clean + 1.0)))
        # the lower end of the ratio's confidence interval: chance finds do not enter
        doubt = 3.5 * math.sqrt(1.0 / (r["toxic_docs"] + 0.5) + 1.0 / (r["clean_docs"] + 0.5))
        if rate > 1.0 and docs - doubt > 0.7:
            scored[r["entry"]] = (r["toxic_docs"] * (docs - doubt), rate)
    # words that were seen often enough are judged by their counts, other seeds by default
    weights: dict[str, float] = {s: 3.0 for s in seeds}
    for entry, (_, rate) in sorted(scored.items(), key=lambda x: (-x[1][0], x[0])):
        if len(weights) >= max_entries:
            break
        nested = [w for w in weights if w.startswith(entry) or entry.startswith(w)]
        if nested:
            if entry in weights:
                weights[entry] = max(weights[entry], min(rate, 6.0))
            continue
        weights[entry] = min(rate, 6.0)
    return weights


def _fit(x: np.ndarray, y: np.ndarray, start: tuple[float, float, float],
         rounds: int = 50) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.array(start)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge,
                               a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", seeds: list[str] = SEEDS,
          max_rows: int = 12_000, max_entries: int = 400) -> Lexicon:
    """Learns from label rows for which ``learn_from`` holds (at most ``max_rows``)."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & learn_from)
             .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
             .dropDuplicates(["_id"])
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    sample = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
              .filter("text IS NOT NULL")
              .join(F.broadcast(known), "_id").select("text", "toxic"))  # max_rows rows
    counts = sample.mapInArrow(
        _count, "entry string, toxic_docs long, clean_docs long, toxic_hits long, clean_hits long")
    sums = counts.groupBy("entry").agg(*(F.sum(c).alias(c) for c in (
        "toxic_docs", "clean_docs", "toxic_hits", "clean_hits")))
    size = sample.groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).collect()
    by = {r["toxic"]: (r["n"], r["words"]) for r in size}
    if set(by) != {0, 1}:
        return Lexicon({s: 3.0 for s in seeds})
    least = max(4, by[1][0] // 100)
    rows = (sums.filter((F.col("toxic_docs") >= least)
                        & (F.col("toxic_docs") * by[0][0] > 2 * F.col("clean_docs") * by[1][0]))
            .orderBy(F.col("toxic_docs").desc(), "clean_docs", "entry").limit(20_000).collect())
    lexicon = Lexicon(_choose(rows, by[1][0], by[0][0], by[1][1], by[0][1], seeds, max_entries))

    def features(batches):
        matcher = lexicon.matcher()
        for b in batches:
            f = [matcher.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in f], pa.float64()),
                 pa.array([v[1] for v in f], pa.float64()), b.column("toxic")],
                ["density", "hits", "toxic"])

    table = sample.mapInArrow(features, "density double, hits double, toxic int").toPandas()
    table = table.sort_values(["density", "hits", "toxic"])  # sums do not depend on task order
    lexicon.coefficients = _fit(table[["density", "hits"]].to_numpy(float),
                                table["toxic"].to_numpy(float), lexicon.coefficients)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """All columns and rows of ``docs`` with a score from 0 to 1; a column of the score's name
    is replaced. Very long texts are matched as a whole, in time linear in their length."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    docs = docs.drop(score_col)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for b in batches:
            scores = [matcher.score(t) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())],
                                             [*b.schema.names, score_col])
    return docs.mapInArrow(work, schema)
