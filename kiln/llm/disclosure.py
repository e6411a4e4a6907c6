"""Personal data, with the terms that give it away by the corpus's own counts.

Protected entities are the addresses, numbers and cards that patterns find (``find_base``); an
entity is a kind and a normalised value. The corpus tells how much a term says about an
entity: with the share of documents that hold it, ``p``, an entity carries ``-log p(e)`` of
information, and a term ``t`` that stands near it reveals ``log p(e, t) / (p(e) p(t))`` of
that. A term that reveals at least the share ``threshold`` of an entity's information, in at
least ``min_contexts`` different surroundings of the entity, discloses it. In documents that
hold the entity, each occurrence of such a term is sanitised: generalised to its class (a
word, a name, a number) where the class itself stays below the threshold, else removed.

Counts cover all documents. Each task pre-aggregates the terms of its documents before
anything is shuffled, pairs of entity and term exist only for terms within ``reach`` words
of an entity, and decisions meet the documents in joins on hashes; texts are never shuffled.

Terms are stretches of at least three word characters in lower case that no base span
touches. Defined results: a null or empty text has no spans; rows with the same id and text
(null ids too) have the same spans, and every row counts as a document; one entity or term
in a third of all documents is aggregated map-side. Very long texts are read in linear time
as a whole. An empty table gives no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.store import Stage

# Kinds in the order in which spans of one start are listed.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "generalise", "remove"]
PLACEHOLDERS = {"email": "<email>", "ip": "<ip>", "card": "<card>", "phone": "<phone>",
                "remove": ""}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive repeats give what greedy ones give here, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"\w{3,}")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches; every match holds one ``@``, so each is tried where it stands."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield "email", start, done
        at = text.find("@", at + 1)


def find_base(text: str) -> list[Span]:
    """``(kind, start, end)`` of the base kinds, by start, then kind; code points."""
    spans = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
               for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def entity_of(kind: str, value: str) -> bytes:
    """One hash for all spellings of an entity."""
    value = value.lower() if kind == "email" else _digits(value) if kind != "ip" else value
    return hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=16).digest()


def class_of(token: str) -> str:
    """What a term is generalised to; no term is spelt like this."""
    if any(c.isdigit() for c in token):
        return "<number>"
    return "<name>" if token[0].isupper() else "<word>"


def row_key(doc_id: int | None, text: str) -> bytes:
    """The identity of a row: its id and its text."""
    return hashlib.blake2b(f"{doc_id}\n{text}".encode("utf-8", "surrogatepass"),
                           digest_size=16).digest()


def near_terms(text: str, spans: list[Span], reach: int) -> tuple[list, list]:
    """``(entity, term, context)`` for the terms and classes near each entity, and
    ``(term, class, start, end)`` of all occurrences of these terms."""
    tokens, j = [], 0
    for m in _TERM.finditer(text):
        while j < len(spans) and spans[j][2] <= m.start():
            j += 1
        if not any(s[1] < m.end() and m.start() < s[2] for s in spans[j:j + len(BASE_KINDS)]):
            tokens.append((m.group().lower(), m.start(), m.end(), class_of(m.group())))
    pairs, near, at = {}, set(), 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        while at < len(tokens) and tokens[at][1] < start:
            at += 1
        window = tokens[max(0, at - reach):at + reach]
        context = hashlib.blake2b(" ".join(t[0] for t in window).encode("utf-8", "surrogatepass"),
                                  digest_size=8).digest()
        entity = entity_of(kind, text[start:end])
        for term, _, _, group in window:
            pairs.setdefault((entity, term), context)
            pairs.setdefault((entity, group), context)
            near.add(term)
    return ([(e, t, c) for (e, t), c in pairs.items()],
            [(t, g, a, b) for t, a, b, g in tokens if t in near])


_SPANS = "array<struct<kind:string,start:long,end:long>>"
_SCAN = (f"doc_id long, key binary, spans {_SPANS}, entities array<binary>, "
         "pairs array<struct<entity:binary,term:string,context:binary>>, "
         "terms array<struct<term:string,group:string,start:long,end:long>>")


def _scan(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        pair = pa.struct([("entity", pa.binary()), ("term", pa.string()), ("context", pa.binary())])
        term = pa.struct([("term", pa.string()), ("group", pa.string()),
                          ("start", pa.int64()), ("end", pa.int64())])
        for b in batches:
            keys, spans, entities, pairs, terms = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                found = find_base(text)
                p, t = near_terms(text, found, reach) if found else ([], [])
                keys.append(row_key(i, text))
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
                entities.append(list({entity_of(k, text[s:e]) for k, s, e in found}))
                pairs.append([dict(zip(("entity", "term", "context"), x)) for x in p])
                terms.append([dict(zip(("term", "group", "start", "end"), x)) for x in t])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(spans, pa.list_(span)),
                 pa.array(entities, pa.list_(pa.binary())), pa.array(pairs, pa.list_(pair)),
                 pa.array(terms, pa.list_(term))],
                ["doc_id", "key", "spans", "entities", "pairs", "terms"])
    return run


#: Terms that a task holds before it passes their counts on.
HELD_TERMS = 200_000


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each term and class, added up per task."""
    def out(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c.keys()), pa.string()), pa.array(list(c.values()), pa.int64())],
            ["term", "docs"])
    held: Counter = Counter()
    for b in batches:
        for text in b.column(0).to_pylist():
            if not text:
                continue
            tokens = set(_TERM.findall(text))
            held.update({t.lower() for t in tokens} | {class_of(t) for t in tokens})
            if len(held) > HELD_TERMS:
                yield out(held)
                held = Counter()
    if held:
        yield out(held)


def disclosures(scan: DataFrame, counts: DataFrame, n_docs: int, threshold: float,
                min_contexts: int) -> DataFrame:
    """``entity, term, share``: terms (and classes) that disclose an entity near them.

    ``share`` is the part of the entity's information that the term reveals."""
    pairs = (scan.select(F.explode("pairs").alias("p")).select("p.*")
             .groupBy("entity", "term")
             .agg(F.count("*").alias("together"), F.count_distinct("context").alias("contexts"))
             .filter(F.col("contexts") >= min_contexts).drop("contexts"))
    entities = (scan.select(F.explode("entities").alias("entity")).groupBy("entity")
                .agg(F.count("*").alias("e_docs")).filter(F.col("e_docs") >= min_contexts))
    n = F.lit(float(n_docs))
    p_e, p_t = F.col("e_docs") / n, F.col("docs") / n
    information = -F.log(p_e)
    revealed = F.log((F.col("together") / n) / (p_e * p_t))
    # an entity in every document carries no information that a term could reveal
    share = F.when(information > 0, revealed / information)
    return (pairs.join(entities, "entity").join(counts, "term")
            .select("entity", "term", share.alias("share"))
            .filter(F.col("share") >= threshold))


def find_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
               threshold: float = 0.9, min_contexts: int = 3, reach: int = 8) -> DataFrame:
    """``doc_id, key, spans`` of every row; spans by start, then kind, in code points."""
    stage = Stage(docs.sparkSession, "disclosure")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scan = stage.put(rows.mapInArrow(_scan(reach), _SCAN), "scan")
    n_docs = scan.count()
    counts = (rows.select("text").mapInArrow(_count_terms, "term string, docs long")
              .groupBy("term").agg(F.sum("docs").alias("docs")))
    found = stage.put(disclosures(scan, counts, n_docs, threshold, min_contexts), "disclosures")
    classes = F.col("term").isin("<word>", "<name>", "<number>")
    # documents with a disclosing term near its entity; repeated rows have one key
    hit = stage.put(scan.select("key", F.explode("pairs").alias("p"))
                    .select("key", "p.entity", "p.term")
                    .join(found.filter(~classes).select("entity", "term"), ["entity", "term"])
                    .distinct(), "hits")
    open_class = found.filter(classes).select("entity", F.col("term").alias("group"),
                                              F.lit(True).alias("open"))
    occurrences = (scan.join(hit.select("key").distinct(), "key", "left_semi")
                   .dropDuplicates(["key"]).select("key", F.explode("terms").alias("t"))
                   .select("key", "t.*"))
    kind = F.when(F.max(F.coalesce("open", F.lit(False))), "remove").otherwise("generalise")
    added = (occurrences.join(hit, ["key", "term"])
             .join(open_class, ["entity", "group"], "left")
             .groupBy("key", "start", "end").agg(kind.alias("kind"))
             .groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    ordered = F.array_sort(F.transform(
        F.concat("spans", F.coalesce("more", F.array().cast(_SPANS))),
        lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"),
                           s["end"].alias("end"), s["kind"].alias("kind"))))
    plain = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"),
                                                    s["start"].alias("start"),
                                                    s["end"].alias("end")))
    return scan.select("doc_id", "key", "spans").join(added, "key", "left").select(
        "doc_id", "key", plain.alias("spans"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            if text and spans:
                out, at = [], 0
                for s in spans:
                    if s["start"] < at:      # kinds may overlap: the first one stands
                        at = max(at, s["end"])
                        continue
                    word = text[s["start"]:s["end"]]
                    out += [text[at:s["start"]],
                            PLACEHOLDERS.get(s["kind"], class_of(word) if word else "")]
                    at = s["end"]
                text = "".join([*out, text[at:]])
            texts.append(text)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                         ["doc_id", "text"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [row_key(i, t or "") for i, t in zip(b.column("doc_id").to_pylist(),
                                                    b.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"),
                                          pa.array(keys, pa.binary())], ["doc_id", "text", "key"])


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, text`` with base spans replaced by their kind, disclosing terms by their
    class or by nothing. Only here texts meet their spans in a join."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spans = find_spans(docs, text, doc_id, **options).filter(F.size("spans") > 0) \
        .select("key", "spans").dropDuplicates(["key"])
    return rows.mapInArrow(_keyed, "doc_id long, text string, key binary") \
        .join(spans, "key", "left").select("doc_id", "text", "spans") \
        .mapInArrow(_rewrite, "doc_id long, text string")
