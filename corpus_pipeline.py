"""The corpus pipeline: toxicity, near-dedup, substring dedup, mixing, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``; ``n_chars`` follows the text.

Stages keep rows with null ids or texts unless a decision concerns them: a null text is
not toxic, has no near-duplicates and no repeats, and mixing takes none of its no words.
Repeated rows are near-duplicates of each other: one stays. Of rows that share id and text but
not their other columns the near-duplicate stage keeps any one. Further columns, whatever
their names, travel with their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import minhash, mixing, packing, store, suffix_array, toxicity
from kiln.llm.memory import gives_back
from kiln.llm.queries import held_out
from kiln.llm.seeds import Unpacker
from kiln.llm.store import Stage

#: SQL cannot express the learned score of the first stage.
ORACLE_SQL = None

def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them as long as ``docs`` has such columns."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    [score] = _free(docs, "_toxicity_score")
    lexicon = toxicity.learn(docs, labels, ~held_out())
    return toxicity.score(docs, lexicon, score_col=score).filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    rows = minhash.near_duplicates(docs, percent=80, shingle=5)[0]
    [text_hash] = _free(docs, "_text_hash")
    key = ["doc_id", text_hash]
    rows = Stage(spark, "near-duplicates").put(
        rows.filter("doc_id IS NOT NULL").withColumnRenamed("text_hash", text_hash), "rows")
    gone = rows.filter("NOT kept").select(*key).distinct()
    stay = docs.withColumn(text_hash, F.xxhash64("text")).join(gone, key, "left_anti")
    repeated = rows.filter("kept").groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    if not repeated.isEmpty():  # rows that share id and text
        stay = stay.join(repeated, key, "left_anti").unionByName(
            stay.join(repeated, key, "left_semi").dropDuplicates(key))
    return stay.select(docs.columns)


@gives_back
def _without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = Unpacker()
    for b in batches:
        texts = []
        for packed, spans in zip(b.column("packed"), b.column("spans")):
            packed, spans = packed.as_py(), spans.as_py()
            # a character that is cut in two goes as a whole
            texts.append(None if packed is None else suffix_array.kept_bytes(
                packed, spans, unpack)[3].decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(texts, pa.string()), b.column("rest")],
            ["doc_id", "text", "rest"])


def _as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in their order, ``n_chars`` counted anew."""
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return rows.select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that starts in two places."""
    found = suffix_array.repeated_bytes(docs, window=200, with_rest=True)
    rest = found.schema["rest"].dataType.simpleString()
    out = found.mapInArrow(_without_spans, f"doc_id long, text string, rest {rest}")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return _as_documents(out.select("doc_id", "text", *[
        F.col("rest").getField(c).alias(c) for c in others]), docs)


def _cut_words(size: str, start: str, words: str):
    @gives_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts down to the words that the mix takes: ``words`` from ``start`` on."""
        import re
        word = re.compile(r"[^\x20\x09-\x0D]+")
        for b in batches:
            names = b.schema.names
            texts = []
            for text, n, first, taken in zip(*(b.column(c).to_pylist() for c in (
                    "text", size, start, words))):
                if taken < n:
                    at = [m.span() for m in word.finditer(text)][first:first + taken]
                    text = text[at[0][0]:at[-1][1]]
                texts.append(text)
            at = names.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)],
                names)
    return cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for every epoch that takes words of a document, with those words."""
    mixed = mixing.mix(docs, weights=(5, 2, 1), max_epochs=3)
    hash_, id_, start, words, size = _free(docs, "_hash", "_id", "_start", "_words", "_size")
    sizes = mixed.documents.select("src", "at", "hash", "doc_id", F.col("size").alias(size))
    # the blocks that an epoch takes are consecutive, so a document's words are one stretch
    taken = (mixed.rows.groupBy("src", "at", "hash", "doc_id", "epoch")
             .agg(F.min("start").alias(start), F.sum("words").alias(words)).alias("t")
             .join(sizes.filter(F.col(size) > 0).alias("s"),
                   [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
                    for c in ("src", "at", "hash", "doc_id")])
             .select(F.col("t.hash").alias(hash_), F.col("t.doc_id").alias(id_),
                     start, words, size))
    one = docs.withColumn(hash_, F.xxhash64("doc_id", "text")).dropDuplicates(["doc_id", hash_])
    rows = one.join(taken, [hash_]).filter(F.col("doc_id").eqNullSafe(F.col(id_)))
    return _as_documents(rows.mapInArrow(_cut_words(size, start, words), rows.schema), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


#: Folders that the stage before has staged tables in.
_staged: list[str] = []


def _frees_the_last(function):
    """A stage's result is written before the next stage is called, so the tables that its
    operators staged are deleted at that call. A result that is read later must be written."""
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _staged:
            store.delete(spark, _staged.pop())
        before = len(store.folders)
        out = function(spark, docs, sf_dir)
        _staged.extend(store.folders[before:])
        return out
    return stage


STAGES = [(name, _frees_the_last(function)) for name, function in (
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage.put(function(spark, docs, sf_dir), name)
    return docs
