"""Ball k-means codes, periodic runs and disclosing terms against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from kiln.llm import ball_codes, basic_factors, disclosure
from kiln.llm.queries import made_periodic


# ------------------------------------------------------------------ ball k-means
def _plain_codes(rows, parts, entries, rounds, scale):
    """Every part against every entry, in Python integers."""
    kept = [(i, lab, [int(np.clip(np.floor(x * scale), -2 ** 24, 2 ** 24)) for x in v])
            for i, lab, v in rows
            if v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    w = len(kept[0][2]) // parts
    cut = [[r[2][p * w:(p + 1) * w] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            for j, g in groups.items():
                books[p][j] = [sum(col) // len(g) for col in zip(*g)]
    coded = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    total = Counter()
    for r, c in zip(kept, coded):
        total[r[1]] += sum(d for d, _ in c)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((r[0], "".join(f"{j:02x}" for _, j in c), sum(d for d, _ in c), total[r[1]], digest)
                   for r, c in zip(kept, coded))


VECTORS = "vec_id long, embedding array<double>, label int, vector string, code int"


def test_codes_equal_plain_k_means(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(8)], [1, 2, None][i % 3]) for i in range(150)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (9, rows[3][1], 2)]          # repeated
    rows += [(200 + i, rows[0][1], 1) for i in range(200)]                         # a hot vector
    rows += [(-5, [float(x) for x in range(8)], None), (None, [0.5] * 8, 3),       # ties, null id
             (900, None, 1), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] * 8, 1),
             (903, [float("inf")] + [0.0] * 7, 1), (904, [], 1), (905, [1.0] * 7, 1),
             (906, [1.0] * 16, 1), (907, [1e307, -1e307] + [0.0] * 6, 4), (908, [-0.5] * 8, 2)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], VECTORS)
    got = ball_codes.compress(frame.repartition(5), parts=4, entries=16, rounds=6, scale=16.0)
    want = _plain_codes([(i, lab, v) for i, v, lab in rows], 4, 16, 6, 16.0)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_codes_of_few_and_no_vectors(spark):
    few = [(1, [0.0] * 8, None, "", 0), (2, [1.0] * 8, 5, "", 0)]
    got = ball_codes.compress(spark.createDataFrame(few, VECTORS)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == [
        (1, "00" * 8, 0, 0), (2, "01" * 8, 0, 0)]
    assert ball_codes.compress(spark.createDataFrame([], VECTORS)).collect() == []


def test_standing_balls_and_rings_change_nothing():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (400, 3))
    entries = rng.integers(-50, 50, (12, 3))
    entries[5] = entries[2]                      # equal entries: the lower index wins
    gaps = ball_codes.entry_gaps(entries)
    want = np.argmin(((x[:, None] - entries[None]) ** 2).sum(2), axis=1)
    for old in (np.zeros(400, np.uint8), rng.integers(0, 12, 400).astype(np.uint8)):
        code, dist = ball_codes.ball_assign(x, entries, gaps, old, np.zeros(12, bool))
        assert (code == want).all()
        assert (dist == ((x - entries[code]) ** 2).sum(1)).all()
    still = ball_codes.standing_balls(entries[None], np.zeros((1, 12), bool), np.zeros((1, 12), np.int64))
    assert still.all()


# ------------------------------------------------------------------ periodic runs
def _plain_runs(w, min_length=6, min_exponent=4):
    out, n = {}, len(w)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def _words(rng):
    w = [f"w{rng.randint(0, rng.choice([1, 2, 6]))}" for _ in range(rng.randint(0, 50))]
    for _ in range(rng.randint(0, 2)):
        p, at = rng.randint(1, 9), rng.randint(0, len(w))
        base = [f"w{rng.randint(0, 3)}" for _ in range(p)]
        w[at:at] = [base[i % p] for i in range(rng.randint(0, 60))]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        docs = [_words(rng) for _ in range(rng.randint(1, 4))]
        flat = [int(x[1:]) for d in docs for x in d]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        assert basic_factors.find_runs(np.array(flat, np.int64), offsets) == [
            _plain_runs(d) for d in docs]


def test_periodic_runs_of_documents(spark):
    rng = random.Random(9)
    texts = [None, "", " \t\x0b ", "a", "a a a a a a", "x\x1cy x\x1cy", "Ü " * 9, "no no no no no"]
    texts += [" ".join(_words(rng)) for _ in range(40)]
    texts += [texts[12], "ab cd ef " * 30_000, " ".join(f"u{i}" for i in range(50_000))]
    rows = [(i if i % 9 else None, t, 7, "runs") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, collapsed string")
    got = Counter((r.doc_id, r.text, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed)
                  for r in basic_factors.periodic_runs(docs.repartition(3)).collect())
    want = Counter()
    for i, t, _, _ in rows:
        w = (t or "").encode().split()
        runs = ([(0, 90_000, 3)] if len(w) == 90_000 else [] if len(w) == 50_000 else _plain_runs(w))
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        want[(i, t, len(w), tuple(runs), kept)] += 1
    assert got == want
    assert basic_factors.periodic_runs(docs.limit(0)).collect() == []


def test_made_periodic_follows_its_rule():
    words = [b"%d" % i for i in range(100)]
    import zlib
    for doc_id in range(300):
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a, want = g % 100, list(words)
        if h % 10 == 0:
            p = 1 + (100 - a) // (3 + g % 8)
            want = [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]
        assert made_periodic(words, doc_id) == want
    assert made_periodic([], 0) == [] and made_periodic(words, None) == words


# ------------------------------------------------------------------ personal data
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "phone": 10 <= len(digits) <= 15,
                    "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and sum(
                        int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))
                        for i, d in enumerate(reversed(digits))) % 10 == 0}[kind]
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    bits = ["a.b@c.d", "@", "@x.y", "1.2.3.4", "256.1.1.1", "1.2.3", "4111 1111 1111 1111", "+", "+1 ",
            "(555) 010-9999", "5500-0000 0000-0004", ".", "-", " ", "x", "9", "é", "００", "a@b@c.d.e", "%+"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert disclosure.find_base(text) == _plain_base(text), text


@pytest.mark.parametrize("bit", ["a", "1", "1.", "+", "@", "a@", "+1 ", "4 ", "."])
def test_long_texts_take_linear_time(bit):
    began = time.time()
    disclosure.find_base(bit * (1_000_000 // len(bit)))
    assert time.time() - began < 20


TEXTS = [f"{w} Ottokar wrote from ott@kar.example about {v}" for w, v in
         [("today", "rivers"), ("then", "stones"), ("later", "glass"), ("again", "the sea")]]
TEXTS += [f"about the weather of day {i} wrote Someone from afar" for i in range(200)]
TEXTS += ["Ottokar again, ott@kar.example far away\nand many other words that follow until ottokar ends"]


def _docs(spark, texts, n=3):
    rows = [(i, t, "s", [i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, spans array<int>").repartition(n)


def _plain_terms(texts, threshold, min_contexts, reach):
    """Spans of disclosing terms by the definition, document by document."""
    import math
    from kiln.llm.disclosure import class_of, entity_of, find_base
    docs = [t or "" for t in texts]
    tokens = []
    for t in docs:
        base = find_base(t)
        tokens.append([(m.group(), m.start(), m.end()) for m in re.finditer(r"\w{3,}", t)
                       if not any(s < m.end() and m.start() < e for _, s, e in base)])
    holds, near, contexts, has = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for d, t in enumerate(docs):
        for w in re.findall(r"\w{3,}", t):
            has[w.lower()].add(d)
            has[class_of(w)].add(d)
        for kind, s, e in find_base(t):
            entity = entity_of(kind, t[s:e])
            holds[entity].add(d)
            before = [x for x in tokens[d] if x[1] < s][-reach:]
            window = before + [x for x in tokens[d] if x[1] >= s][:reach]
            for w, _, _ in window:
                for term in (w.lower(), class_of(w)):
                    if d not in near[entity, term]:
                        near[entity, term].add(d)
                        contexts[entity, term].add(" ".join(x[0].lower() for x in window))
    share = {}
    for (entity, term), ds in near.items():
        n, e, k = len(docs), len(holds[entity]), len(has[term])
        if len(contexts[entity, term]) >= min_contexts and e < n:
            share[entity, term] = math.log(len(ds) * n / (e * k)) / math.log(n / e)
    out = []
    for d, t in enumerate(docs):
        spans = {(k, s, e) for k, s, e in find_base(t)}
        for w, s, e in tokens[d]:
            hits = [x for (x, term), v in share.items()
                    if term == w.lower() and v >= threshold and d in near[x, term]]
            if hits:
                open_ = any(share.get((x, class_of(w)), 0) >= threshold for x in hits)
                spans.add(("remove" if open_ else "generalise", s, e))
        out.append((d, sorted(spans, key=lambda x: (x[1], disclosure.KINDS.index(x[0])))))
    return out


def test_disclosing_terms(spark):
    texts = TEXTS + [None, "", "x" * 200_000 + " ott@kar.example", TEXTS[0], TEXTS[5]]
    want = _plain_terms(texts, 0.9, 3, 8)
    got = sorted((r.doc_id, [tuple(s) for s in r.spans])
                 for r in disclosure.find_spans(_docs(spark, texts)).collect())
    assert got == want
    named = [s for _, spans in got for s in spans if s[0] == "generalise"]
    assert len(named) == 7 and all(not spans for d, spans in got if 4 <= d < 204)
    clean = {r.doc_id: r.text for r in disclosure.sanitise(_docs(spark, texts)).collect()}
    assert clean[0] == "today <name> wrote from <email> about rivers"
    assert clean[204].endswith("until <word> ends") and clean[5] == texts[5] and clean[205] is None


def test_classes_that_disclose_are_removed(spark):
    texts = [f"{w} call Zed at +1 555 010 9999 {w}" for w in ("aaa", "bbb", "ccc", "ddd")]
    texts += [f"nothing here {i % 7}" for i in range(60)]
    want = _plain_terms(texts, 0.9, 3, 8)
    got = sorted((r.doc_id, [tuple(s) for s in r.spans])
                 for r in disclosure.find_spans(_docs(spark, texts)).collect())
    assert got == want
    assert [k for k, _, _ in got[0][1]].count("remove") == 1      # no other capitalised term


def test_repeated_rows_hot_entity_and_empty_tables(spark):
    rows = [(None, TEXTS[0])] * 50 + [(1, TEXTS[1])] * 2 + [(2, TEXTS[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = disclosure.find_spans(docs).collect()
    assert len(got) == 53 and len({(r.doc_id, str(r.spans)) for r in got}) == 3
    assert disclosure.find_spans(docs.limit(0)).collect() == []


# ------------------------------------------------------------------ hosts, overflow, catalog
def test_long_hosts_are_probed_at_the_depths_of_rules(spark):
    from kiln.llm import url_rules
    deep = ".".join(["a"] * 200_000)
    assert url_rules.probe_keys(f"{deep}.example.com", "/x", [1, 2]) == [("com", "/x"), ("com.example", "/x")]
    assert url_rules.probe_keys("b.c", "/", [1, 3]) == [("c", "/")] and url_rules.probe_keys("", "/", [1]) == []
    pages = spark.createDataFrame([(1, f"http://{deep}.example.com/en/"), (2, "http://com/"), (3, f"x://{deep}")],
                                  "page_id long, url string")
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("www.example.com", "/", "allow"), ("com", "/", "allow")],
                                  "host string, path string, verdict string")
    for many in (1000, 1):
        got = {r.page_id: r.rule for r in url_rules.judge_urls(pages, rules, broadcast_rules=many).collect()}
        assert got == {1: "example.com/en/", 2: "com/", 3: None}


def test_scores_of_huge_components_saturate(spark):
    from pyspark.sql import functions as F

    from kiln.llm import topk_search
    rows = [(0, [1e307, 1.0]), (1, [1e9, 0.0]), (2, [1e9, 0.0]), (3, [-1e307, 0.0]), (4, [1.0, 0.0]), (None, [1e9, 1.0]),
            (50, [0.5, 0.25])]
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=9)
    top = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()}
    most = 2 ** 63 - 1
    assert [top[0, i] for i in range(1, 6)] == [(1, most), (2, most), (4, most), (50, most), (3, -most - 1)]
    assert top[50, 1] == (0, most) and top[50, 2] == (1, 128 * 256 * 10 ** 9) and top[50, 4] == (4, 128 * 256)


def test_no_catalog_entry_is_left(spark):
    from kiln.llm import suffix_array
    docs = spark.createDataFrame([(1, "ab" * 300, "s"), (2, "x" + "ab" * 300, "s")], "doc_id long, text string, source string")
    found = suffix_array.repeated_bytes(docs)
    assert not [t for t in spark.catalog.listTables() if "kiln" in t.name]
    assert found.count() == 2
