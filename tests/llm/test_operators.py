"""Operators against brute force on small tables with nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.llm import (chat, lattice_dedup, minhash, mixing, packing, suffix_array, suffix_tree,
                      topk_search, toxicity, url_rules)
from kiln.llm.seeds import Unpacker, sliding_argmin

DOCS = "doc_id long, text string, source string, size int, rep string"


def _texts(n=60, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["the", "of", "Ünï"]
    shared = " ".join(rng.choice(vocab) for _ in range(70))
    out = [None, "", " \t\n", "one", "one two three four five"]
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(1, 90))]
        text = " ".join(words)
        if i % 3 == 0:
            text = text + " " + shared[rng.randint(0, 60):]
        out.append(text)
    out += [out[10], out[10], out[12].replace("w1", "x"), shared * 12, "ab" * 700]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["a", "b", None][i % 3], 1, "z") for i, t in enumerate(_texts())]
    rows += [(20, rows[20][1], "a", 1, "z"), (None, rows[21][1], "a", 1, "z")]
    return spark.createDataFrame(rows, DOCS)


def _rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_sliding_argmin_is_leftmost():
    h = np.array([random.Random(i).randint(0, 5) for i in range(200)], np.uint64)
    for width in (1, 3, 9):
        assert sliding_argmin(h, width).tolist() == [
            i + int(np.argmin(h[i:i + width])) for i in range(len(h) - width + 1)]


@pytest.mark.parametrize("max_group", [4096, 1])
def test_repeated_words(docs, max_group):
    rows = _rows(docs)
    order = lambda i: 2 ** 63 - 1 if i is None else i
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, order(i)), order(i))
    want = Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < order(i)
                for j in range(k, k + 13)}
        want[(i, len(w), b" ".join(x for j, x in enumerate(w) if j not in gone))] += 1
    got = Counter()
    for r in suffix_tree.repeated_words(docs, max_group=max_group).collect():
        n, _, kept = suffix_tree.kept_words(r.packed, [s.asDict() for s in r.spans or []], Unpacker())
        got[(r.doc_id, n, b" ".join(kept))] += 1
    assert got == want


def _kept_bytes_want(rows):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k:k + 200] for k in range(len(b) - 199))
    want = Counter()
    for i, t in rows:
        b = (t or "").encode()
        gone = {j for k in range(len(b) - 199) if seen[b[k:k + 200]] > 1 for j in range(k, k + 200)}
        want[(i, bytes(x for j, x in enumerate(b) if j not in gone))] += 1
    return want


def _kept_bytes(docs, max_group):
    got = Counter()
    for r in suffix_array.repeated_bytes(docs, max_group=max_group).collect():
        kept = suffix_array.kept_bytes(r.packed, [s.asDict() for s in r.spans or []], Unpacker())
        got[(r.doc_id, kept[3])] += 1
    return got


@pytest.mark.parametrize("max_group", [4096, 1])
def test_repeated_bytes(docs, max_group):
    assert _kept_bytes(docs, max_group) == _kept_bytes_want(_rows(docs))


def test_hot_grams_go_to_the_array_by_longer_strings(spark, monkeypatch):
    """One line in all texts, between different ones: no window of it becomes a row."""
    rng = random.Random(11)
    own = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line = own(90)
    texts = [own(rng.randint(0, 150)) + line + own(rng.randint(60, 200)) for _ in range(40)]
    for i in range(0, 40, 5):  # reaches far to the left, far to the right, or over both sides
        at = texts[i].index(line)
        texts += [own(30) + texts[i][max(0, at - 120):at + 100] + own(90),
                  own(90) + texts[i][at - 10 if at > 9 else 0:] + own(40), own(50) + texts[i] + own(9)]
    rows = [(i, t, "a", 1, "z") for i, t in enumerate(texts)]
    hot = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(suffix_array.RepeatFinder, "window_rows", None)
    assert _kept_bytes(hot, 24) == _kept_bytes_want([r[:2] for r in rows])


def _components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_minhash_components(spark):
    rng = random.Random(1)
    base = [" ".join(f"v{rng.randint(0, 999)}" for _ in range(60)) for _ in range(4)]
    texts = [None, "", "few words", "Few  WORDS"]
    for b in base:
        for _ in range(8):
            w = b.split()
            w[rng.randint(0, 3) if rng.random() < .7 else rng.randint(20, 40)] = f"x{rng.randint(0, 9)}"
            texts.append(" ".join(w))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = _components(range(len(sets)), links)
    rows = minhash.near_duplicates(df, percent=85)[0].collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (want[r.doc_id] == r.doc_id)
               for r in rows)


def test_alike_sets_that_are_no_links_are_hardly_written(spark, monkeypatch):
    """60 texts of one base, each pair some 0.75 alike: they meet in tables, none is linked."""
    rng = random.Random(7)
    base = [f"v{rng.randint(0, 9999)}" for _ in range(400)]
    texts = []
    for _ in range(60):
        w = list(base)
        for at in rng.sample(range(400), 6):
            w[at] = f"x{rng.randint(0, 3)}"
        texts.append(" ".join(w))
    texts += [texts[0] + " end", texts[1].replace(base[200], "new")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    alike = sum(len(a & b) >= .65 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert alike > 1500 and len(links) < 60
    met, put = [], minhash.Stage.put

    def counted(self, df, name):
        out = put(self, df, name)
        met.append(out.count() if name == "met" else 0)
        return out
    monkeypatch.setattr(minhash.Stage, "put", counted)
    rows = minhash.near_duplicates(df, percent=85)[0].collect()
    assert {r.doc_id: r.component_id for r in rows} == _components(range(len(sets)), links)
    assert sum(met) < 300


def test_alike_sets_share_few_keys(spark, monkeypatch):
    """80 near copies of one text: once 120 keys each, now at most 16."""
    rng = random.Random(5)
    base = [f"v{rng.randint(0, 9999)}" for _ in range(200)]
    texts = []
    for _ in range(80):
        w = list(base)
        w[rng.randint(0, 199)] = f"x{rng.randint(0, 99)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    keys, put = [], minhash.Stage.put

    def counted(self, df, name):
        out = put(self, df, name)
        keys.append(out.count() if name == "keys" else 0)
        return out
    monkeypatch.setattr(minhash.Stage, "put", counted)
    rows = minhash.near_duplicates(df, percent=85)[0].collect()
    assert {r.component_id for r in rows} == {0}
    assert 0 < sum(keys) <= 16 * 80


def test_sets_that_agree_in_two_values_share_a_key(spark):
    """With values of few sets, of many that agree (dense) and of many that do not (split)."""
    rng = random.Random(6)
    vals = [[rng.randint(0, 400) for _ in range(16)] for _ in range(120)]
    for i in range(60):  # one value in common, the others mostly not: split
        vals[i][2] = vals[i][9] = 1000 + i % 2
        vals[i][12] = 2000
    for v in vals[60:]:  # alike: dense
        v[:8] = [3000 + rng.randint(0, 1) for _ in range(8)]
    reps = spark.createDataFrame([(i, 10, v) for i, v in enumerate(vals)], "rep long, n long, vals array<long>")
    docs = spark.createDataFrame([], "doc_id long, text string")
    keys = minhash._Dedup(docs, 85, 5, 16, 3)._keys(reps).collect()
    mine = {}
    for r in keys:
        mine.setdefault(r.rep, set()).add(r.key)
    for i, a in enumerate(vals):
        for j in range(i):
            if sum(x == y for x, y in zip(a, vals[j])) > 1:
                assert mine.get(i, set()) & mine.get(j, set())
    assert not any(mine[i] & mine[j] for i in range(60) for j in range(60, 120)
                   if i in mine and j in mine and not any(x == y for x, y in zip(vals[i], vals[j])))
    # a split value is no key by itself
    assert any(sum(x == y for x, y in zip(vals[i], vals[j])) == 1 and not mine[i] & mine[j]
               for i in range(60) for j in range(i))


def test_odd_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    for n, change in ((5, 2), (300, 40), (3000, 900), (20_000, 9000)):
        a = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        b = np.r_[a[change:], rng.integers(0, 2 ** 63, change, dtype=np.uint64)]
        x, y = (minhash.odd_sketch(s).view(np.uint8) for s in (a, b))
        assert np.unpackbits(x ^ y).sum() <= len(np.setxor1d(a, b))
        assert not (minhash.odd_sketch(a) ^ minhash.odd_sketch(a[::-1])).any()


def test_likely_keeps_all_wanted_rows(spark):
    rows = spark.range(20_000).withColumn("t", F.concat(F.lit("t"), "id"))
    for at_most in (2 ** 26, 2 ** 15):  # also more keys than bits have room for
        wanted = rows.filter("id % 3 = 0").select(F.col("id").alias("w"))
        few = minhash.likely(rows, ["id"], wanted, ["w"], at_most)
        assert few.columns == rows.columns
        assert few.join(wanted, few["id"] == wanted["w"]).count() == wanted.count()
        assert few.count() < (8500 if at_most > 2 ** 15 else 12_000)
    assert minhash.likely(rows, ["id"], wanted.limit(0), ["w"]).count() == 0


def test_lattice_links_and_search(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 16))
    vectors = [(b + 0.12 * rng.normal(size=16)).tolist() for b in base for _ in range(6)]
    vectors += [vectors[0], vectors[0], [0.0] * 16, None, [], [float("nan")] * 16, [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>, label int")
    ok = [i for i, v in enumerate(vectors) if v and len(v) == 16 and np.isfinite(v).all() and any(v)]
    unit = {i: np.array(vectors[i]) / np.linalg.norm(vectors[i]) for i in ok}
    links = [(i, j) for i in ok for j in ok if j < i and unit[i] @ unit[j] >= 0.95]
    n = Counter(x for pair in links for x in pair)
    want = _components(range(len(vectors)), links)
    rows = lattice_dedup.near_duplicates(df)[0].collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {
        i: (n[i], want[i]) for i in range(len(vectors))}

    quantised = {i: np.floor(256 * np.array(v)) for i, v in enumerate(vectors)
                 if v is not None and np.isfinite(v).all()}
    got = defaultdict(list)
    for r in topk_search.top_k(df, F.col("vec_id") % 7 == 0, shard_rows=9, query_block=3,
                               fan_in=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in (i for i in quantised if i % 7 == 0):
        scores = sorted((-int(quantised[q] @ c), i) for i, c in quantised.items()
                        if i != q and len(c) == len(quantised[q]))[:5]
        assert got.get(q, []) == [(i, -s) for s, i in scores]


def test_e8_points_are_nearest():
    x = np.random.default_rng(1).normal(size=(500, 8)) * 2
    p = lattice_dedup.decode(x)
    d = ((x - p) ** 2).sum(1)
    others = ((x[:, None] - p[:, None] - lattice_dedup.ROOTS) ** 2).sum(2).min(1)
    assert (d <= others + 1e-9).all() and len(lattice_dedup.ROOTS) == 240


def test_toxicity_folds_and_exceptions():
    m = toxicity.Lexicon({w: 3.0 for w in toxicity.SEEDS}, coefficients=(-3.0, 2.0, 2.0)).matcher()
    for text in ("you 1d10t", "ｉｄｉｏｔ", "mоrоn there", "tr@sh person", "IDIOTS"):
        assert m.score(text) >= 0.5, text
    for text in (None, "", "the trash can is full", "a clown fish", "100% fine $$$ !!!"):
        assert m.score(text) < 0.5, text


def test_toxicity_reads_long_runs_and_either_letter():
    m = toxicity.Lexicon({w: 3.0 for w in toxicity.SEEDS}, coefficients=(-3.0, 2.0, 2.0)).matcher()
    for text in ("l053r", "b4574rd", "455h0l3", "w0rthl355", "1oser", "a55ho1e", "|oser", "1d10t5", "1d|ot",
                 "!!!idiot", "wow!!!idiot", "y0u!!!1d10t", "w0rth1355"):
        assert m.score(f"you {text} there") >= 0.5, text
    for text in ("c1own f1sh", "the tra5h can!!!", "call 555-1000 or 1l1l1l", "a1000 b2000", "pi1e 100m $$$5"):
        assert m.score(text) < 0.5, text
    plain = toxicity.Lexicon({"mall": 3.0}, coefficients=(-3.0, 2.0, 2.0)).matcher()
    assert plain.score("ma1l") >= 0.5 and plain.score("mail mai1") < 0.5


def test_mixing(docs):
    m = mixing.mix(docs, min_slots=500, bucket_rows=7)
    rows = mixing.taken_per_document(m).collect()
    assert len(rows) == docs.count() and all(r.taken <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r.target] += r.taken
    assert abs(sum(per) - total) < 1e-6
    assert all(abs(taken - target) <= 0.03 * total for target, taken in per.items())
    again = mixing.taken_per_document(mixing.mix(docs, min_slots=500, bucket_rows=7)).collect()
    assert Counter(rows) == Counter(again)
    assert mixing.targets([100, 10, 100], [5, 2, 1]) == [150.0, 30.0, 30.0]


def test_mixing_small_sources(spark):
    sizes = {"a": [300] * 400, "b": [300] * 300, "c": [300] * 200, "d": [50], "e": [5, 0, 40], "f": [1], "g": [900] * 3}
    rows = [(k, " ".join(["w"] * n), k) for k, many in sizes.items() for n in many]
    docs = spark.createDataFrame([(i, t, s) for i, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    m = mixing.mix(docs, min_slots=500, bucket_rows=64)
    taken = {r.src: r.words for r in m.rows.groupBy("src").agg(F.sum("words").alias("words")).collect()}
    assert m.sources[3]["target"] == 150.0
    for s in m.sources:
        assert abs(taken.get(s["src"], 0) - s["target"]) <= max(0.5, s["target"] / 128), s
    assert all(r.taken <= 3 * r["size"] for r in mixing.taken_per_document(m).collect())
    slots = sorted(m.rows.select("slot", "src").distinct().collect())
    assert [r.slot for r in slots] == list(range(sum(s["slots"] for s in m.sources)))
    for prefix in range(1, len(slots), 97):
        seen = Counter(r.src for r in slots[:prefix])
        for s in m.sources:
            assert abs(seen[s["src"]] - prefix * s["slots"] / len(slots)) <= 4
    for n in (1, 2, 3, 1000, 65_536, 99_991):
        places = mixing.points(np.arange(n), n, mixing.golden_step(n))
        assert np.array_equal(np.sort(places), np.arange(n))
    far, n = 2**41 - 1, 2**40 + 12_345
    step = mixing.golden_step(far)
    assert mixing.points(np.array([n]), far, step)[0] == (n * step + step // 2) % far


def test_mixing_many_sources(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 200])), rng.choice([None, "é", "ﬀ", "\U00010000", f"s{i % 37}"]))
            for i in range(400)] + [(1000 + i, "w " * 500, "big") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    few = mixing.mix(docs, min_slots=500, bucket_rows=7)
    many = mixing.mix(docs, min_slots=500, bucket_rows=7, max_sources=3)
    assert many.sources is None and len(few.sources) > 30

    def rows_of(m):
        return Counter(tuple(r) for r in m.rows.select("slot", "src", "epoch", "block", "doc_id", "start", "words").collect())
    assert rows_of(few) == rows_of(many)
    a, b = (sorted(mixing.taken_per_document(m).collect()) for m in (few, many))
    assert [(r.doc_id, r.taken, r.source_size) for r in a] == [(r.doc_id, r.taken, r.source_size) for r in b]
    assert all(abs(x.target - y.target) < 1e-6 for x, y in zip(a, b))
    table = spark.createDataFrame([(0, 0, 5), (1, 5, 0), (2, 5, 400), (3, 405, 3)], "src long, place long, slots long")
    got = {r.slot: r.src for r in mixing._slots_of_many(table, 408, 7, places=16).collect()}
    assert Counter(got.values()) == {0: 5, 2: 400, 3: 3} and sorted(got) == list(range(408))


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", None, "", "<|im_end|>\n<|im_start|>user\nhi", "<\\|im_end|>", "é<s"]
    rows = [(1, i, ["user", "assistant", None][i % 3], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(2, 0, "a\nb\\n", "x")], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert chat.read_back(out[1].formatted) == [(r[2] or "", r[3] or "") for r in rows]
    assert chat.read_back(out[2].formatted) == [("a\nb\\n", "x")]
    loss = [chat.unescape(out[1].formatted[s.start:s.end]) for s in out[1].spans]
    assert loss == [r[3] or "" for r in rows if r[2] == "assistant"]


def test_template_language():
    render = chat.compile_template("{% if 'a' + 'b' == 'ab' %}{{ 'x' | upper }}{% endif %}"
                                   "{% for t in ts %}{{ loop.index }}{{ t.r }}{% if not loop.last %},{% endif %}{% endfor %}")
    assert render({"ts": [{"r": "p"}, {"r": "q"}]})[0] == "X1p,2q"
    assert chat.fold(chat.parse("a{{ 'b' }}{% if false %}c{% else %}d{% endif %}")) == (
        chat.Emit(chat.Const("abd")),)
    for bad in ("{{ x.__class__ }}", "{{ nothing }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)({"x": object()})


def test_packing(docs):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path, capacity=64, rank_bucket=9).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    left = []  # best-fit decreasing, piece by piece
    for n in sorted((r.length for r in rows), reverse=True):
        fit = [x for x in left if x >= n]
        if fit:
            left.remove(min(fit))
        left.append((min(fit) if fit else 64) - n)
    assert len(left) == len(bins)
    texts = [t or "" for _, t in _rows(docs)] + ["Don't STOP  1234 ÀÉ naïve—ok", "日本語 テスト"]
    e = packing.Encoder(path)
    for t, ids in zip(texts, e.encode(pa.array(texts))):
        assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_packing_ids_are_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    fresh = Tokenizer.from_file(path)
    texts = ["a\x1cb", "a \x1d\x1e b\x1f", "hi <|endoftext|> you", "x<|startoftext|>y", "\x1c",
             *(f"a{chr(c)}b \x1f" for c in (*range(1, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2030),
                                           0x205F, 0x2060, 0x3000, 0xFEFF))]
    for t, ids in zip(texts, packing.Encoder(path).encode(pa.array(texts))):
        assert ids.tolist() == fresh.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("remember", [64 << 20, 100_000, 0])
def test_encoder_in_any_memory(remember):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(2)
    bits = [*"abcZ'sStTreVELLmd  \t\n\x0b\x1c\x1f\x85\xa0.,!-~_09²½µªßÀÉéñÿ<|>", "<|endoftext|>", "\u2003", "\u3000",
            "Σ", "İ", "e\u0301", "ǅ", "中", "😀", "\u200b", "'ll", "Ⅷ", " ~ ", " the "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["", "x y " * 300_000]
    encoder, fresh = packing.Encoder(path, remember_bytes=remember), Tokenizer.from_file(path)
    for lo in range(0, len(texts), 700):
        some = texts[lo:lo + 700]
        for t, ids in zip(some, encoder.encode(pa.array(some))):
            assert ids.tolist() == fresh.encode(t, add_special_tokens=False).ids
        assert 2 * encoder.held <= max(remember, 1000)


def test_packing_gives_memory_back(monkeypatch):
    """Texts are encoded a megabyte at a time; freed memory returns within and after a task."""
    import public_tokenizers
    path, given, sizes = public_tokenizers.path("word_bpe_49k.json"), [], []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    monkeypatch.setattr("kiln.llm.memory.give_back", lambda: given.append(1))
    encode = packing.Encoder.encode
    monkeypatch.setattr(packing.Encoder, "encode", lambda self, texts: (
        sizes.append(sum(map(len, texts.to_pylist()))), encode(self, texts))[1])
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["some words " * 50_000] * 40)],
                                       ["doc_id", "text"])
    packed = list(packing._cut(path, 2048, 0, packing.TEXT_AT_ONCE)(iter([batch])))
    assert {d for b in packed for d in b.column("doc_id").to_pylist()} == set(range(40))
    assert max(sizes) <= 1 << 20 and len(given) >= 3


def test_packed_pieces_are_the_documents(spark):
    """Every field of op9 at its capacity against the definition."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    fresh = Tokenizer.from_file(path)
    rng = random.Random(11)
    texts = [None, "", " ", "one", "word " * 2047, "word " * 2048, "word " * 5000, "a,b " * 40_000]
    texts += [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 900))) for _ in range(60)]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "x"), (9, texts[9], 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int, length string").repartition(3)
    got = packing.pack(docs, path, capacity=2048, end_id=0, text_at_once=5000).collect()
    want = Counter()
    for i, t, _, _ in rows:
        ids = np.array([*fresh.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            piece = ids[at:at + 2048]
            want[i, n, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    assert all(sorted(b)[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(sorted(b), sorted(b)[1:]))
               and sum(n for _, n in b) <= 2048 for b in bins.values())


@pytest.mark.parametrize("broadcast_rules", [1000, 1])
def test_url_rules_ties(spark, broadcast_rules):
    rules = [("com", "/xxxxx", "block"), *((f"h{i}.com", "/x", "allow") for i in range(10, 60))]
    df = spark.createDataFrame([(i, f"http://h{10 + i % 50}.com/xxxxx/y") for i in range(400)], "page_id long, url string")
    got = url_rules.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"),
                               broadcast_rules=broadcast_rules, ranges=16).collect()
    assert len(got) == 400
    for r in got:
        assert (r.rule, r.verdict) == (f"h{10 + r.page_id % 50}.com/x", "allow"), r


@pytest.mark.parametrize("broadcast_rules", [100, 1])
def test_url_rules(spark, broadcast_rules):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
    urls = [None, "", "nohost", "http://WWW.Example.com/en/1?x#y", "http://example.com/en/", "ftp://a.net/es/1",
            "http://a.net/de", "http://com", "http://com/", "x://notexample.com/en/", "http://a..com/en/#z"] * 3
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge_urls(
        df, spark.createDataFrame(rules, "host string, path string, verdict string"),
        broadcast_rules=broadcast_rules, ranges=3).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow")), u


def test_empty_tables(spark):
    d = spark.createDataFrame([], DOCS)
    assert suffix_tree.repeated_words(d).count() == 0
    assert suffix_array.repeated_bytes(d).count() == 0
    assert minhash.near_duplicates(d)[0].count() == 0
    assert mixing.taken_per_document(mixing.mix(d)).count() == 0
    import public_tokenizers
    assert packing.pack(d, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice_dedup.near_duplicates(v)[0].count() == 0
    assert topk_search.top_k(v, F.col("vec_id") % 50 == 0).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(d, toxicity.learn(d, labels, F.lit(True))).count() == 0
    t = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(t).count() == 0


def test_digest_of_loss_is_sha256_of_text():
    assert hashlib.sha256(chat.unescape(chat.escape("[/INST]")).encode()).hexdigest() == \
        hashlib.sha256(b"[/INST]").hexdigest()
