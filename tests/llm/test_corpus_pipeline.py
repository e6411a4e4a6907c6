"""The five stages of the pipeline on tables with nulls, repeats, long texts and columns whose
names the stages use themselves."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars int, _id int, _ string, _text_hash string,"
           " _hash string, _size int, _start string, _words int, score double, _toxicity_score string, rest int")
INSULT = "you are a worthless idiot and a pathetic loser, shut up you stupid moron"


def _extra(i):
    return (i, "u", f"t{i}", "h", i, "s", i, 0.5, "x", i)


def _row(i, text, source="a"):
    return (i, text, "en", source, len(text or ""), *_extra(i or 0))


def _words(rng, n):
    return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = [_words(rng, rng.randint(5, 120)) for _ in range(60)]
    shared = _words(rng, 60)
    rows = [_row(i, t, "abc"[i % 3]) for i, t in enumerate(texts)]
    rows += [_row(100, None), _row(101, ""), _row(102, " \t"), _row(103, "long " + _words(rng, 40_000), "d")]
    rows += [_row(104, texts[5]), _row(105, texts[5]), _row(6, texts[6]), _row(6, texts[6])]     # copies, repeated rows
    rows += [_row(106, texts[7] + " end"), _row(None, texts[8]), _row(None, None)]
    rows += [_row(110 + i, f"{_words(rng, 30)} {shared} {_words(rng, 30)}", "b") for i in range(3)]
    rows += [_row(120 + i, f"{INSULT} {_words(rng, 6)}") for i in range(30)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    labels = [(i, 1, int(INSULT in (t or ""))) for i, t, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def _whole(df):
    return Counter(map(tuple, df.collect()))


def test_toxic_documents_go_and_clean_ones_stay_whole(spark, docs, rows, sf_dir):
    out = cp.drop_toxic(spark, docs, sf_dir)
    assert out.columns == docs.columns
    got, clean = _whole(out), Counter(r for r in rows if INSULT not in (r[1] or ""))
    assert not clean - got
    assert sum((got - clean).values()) <= 3          # nearly all of the 30 toxic ones are found


def _sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_one_document_of_each_near_group_stays(spark, docs, rows, sf_dir):
    out = cp.drop_near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    sets = {r[:2]: _sets(r[1]) for r in rows}
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    keyed = [(i, s) for (i, _), s in sets.items() if i is not None and s]
    for n, (a, x) in enumerate(keyed):
        for b, y in keyed[n + 1:]:
            if 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    want = set()
    for r in rows:
        if r[0] is None or not sets[r[:2]] or find(r[0]) == r[0]:
            want.add(r)
    got = _whole(out)
    assert set(got) == want
    assert got[next(r for r in rows if r[0] == 6)] == 1 and got[_row(None, None)] == 1


def test_repeated_passages_go_from_all_their_places(spark, docs, rows, sf_dir):
    out = cp.drop_repeated_passages(spark, docs, sf_dir)
    assert out.columns == docs.columns
    small = [r for r in rows if len(r[1] or "") < 10_000]
    places = Counter()
    for r in rows:
        b = (r[1] or "").encode()
        places.update(b[k:k + 200] for k in range(len(b) - 199))
    want = Counter()
    for r in small:
        b = (r[1] or "").encode()
        gone = {j for k in range(len(b) - 199) if places[b[k:k + 200]] > 1 for j in range(k, k + 200)}
        text = bytes(x for j, x in enumerate(b) if j not in gone).decode()
        want[(r[0], text or None, *r[2:4], len(text), *r[5:])] += 1
    got = Counter((r[0], r[1] or None, *r[2:]) for r in out.collect() if r[0] != 103)
    null_chars = Counter({(*k[:4], k[4] or 0, *k[5:]): n for k, n in got.items()})
    assert null_chars == want


def test_mix_takes_words_near_the_targets(spark, docs, rows, sf_dir):
    out = cp.mix_sources(spark, docs, sf_dir)
    assert out.columns == docs.columns
    size, taken = defaultdict(int), defaultdict(int)
    seen = set()
    for r in rows:
        size[r[3]] += len((r[1] or "").split())
        seen.add(r[0])
    whole = {r[0]: (r[1] or "").split() for r in rows if r[0] is not None}
    for r in out.collect():
        taken[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text) and r.rest == (r.doc_id or 0)
        if r.doc_id is not None:
            words = r.text.split()
            first = [i for i, w in enumerate(whole[r.doc_id]) if w == words[0]]
            assert any(whole[r.doc_id][i:i + len(words)] == words for i in first)
    assert sum(taken.values()) == pytest.approx(sum(size.values()), rel=0.1)
    assert all(taken[s] <= 3 * size[s] + 200 for s in size)


def test_packing_stage_places_every_row(spark, docs, rows, sf_dir):
    out = cp.pack_sequences(spark, docs, sf_dir).collect()
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(r[0] for r in rows)


def test_stages_of_empty_tables(spark, docs, sf_dir):
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_a_stage_frees_what_the_last_one_staged(spark, docs, sf_dir):
    import os
    here = lambda f: os.path.isdir(f.removeprefix("file:"))
    last: list[str] = []
    for _, stage in cp.STAGES:
        out = stage(spark, docs, sf_dir)
        assert not any(here(f) for f in last)
        out.collect()
        last = [f for f in cp._staged if here(f)]
    assert last                                   # the last stage's tables are there as long as they are read
