"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op2_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

SQL["op10_url_rules"] = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT page_id, host, path,
         (SELECT max_by(rh || rp || ' ' || v, length(rh || rp)) FROM r
          WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS hit
  FROM u
)
SELECT page_id, host, path, split_part(hit, ' ', 1) AS rule,
       coalesce(split_part(hit, ' ', 2), 'allow') AS verdict
FROM m
"""

SQL["op7_chat_template"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *,
    length(text) + len(regexp_extract_all(text,
      '<\\*\|im_start\|>|<\\*\|im_end\|>|<\\*\|endoftext\|>|<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>')) AS n_text,
    length(role) + len(regexp_extract_all(role, '[\\\n]')) AS n_role
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n_text + n_role + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL["op1_lattice_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), c(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.y, c.root FROM c JOIN l ON c.node = l.x
), m AS (SELECT node, min(root) AS component_id FROM c GROUP BY node),
n AS (SELECT x, count(*) AS k FROM l GROUP BY x)
SELECT vec_id, coalesce(k, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON vec_id = node LEFT JOIN n ON vec_id = x
"""

SQL["op6_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + least(5, len(w)) - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (g)
    WHERE a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= 85 * (p.k + q.k - common)
), c(node, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.y, c.root FROM c JOIN l ON c.node = l.x
), m AS (SELECT node, min(root) AS component_id FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.k, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON d.doc_id = node LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _ball_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means over every part position, unrolled round by round."""
    ctes = [f"""v AS (
  SELECT vec_id, label, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""p AS MATERIALIZED (
  SELECT vec_id, part, e[part * w + 1 : part * w + w] AS x
  FROM v, (SELECT unnest(range({parts})) AS part)
)""", f"""c0 AS MATERIALIZED (
  SELECT part, j, x AS c FROM p JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM v ORDER BY vec_id LIMIT {entries}) USING (vec_id)
)"""]
    for n in range(rounds + 1):
        # distance and index in one number: the least distance, then the least index
        ctes.append(f"""a{n} AS MATERIALIZED (
  SELECT vec_id, part, any_value(x) AS x, min({entries} * CAST(list_sum(list_transform(list_zip(x, c),
         lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS HUGEINT) + j) AS m
  FROM p JOIN c{n} USING (part) GROUP BY vec_id, part
)""")
        if n < rounds:
            ctes.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c{n}.part, c{n}.j, coalesce(f, c{n}.c) AS c FROM c{n} LEFT JOIN (
    SELECT part, j, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY i) AS f FROM (
      SELECT part, m % {entries} AS j, i, CAST(sum(x[i]) AS HUGEINT) AS s, count(*) AS k
      FROM a{n}, (SELECT unnest(range(1, (SELECT max(w) FROM v) + 1)) AS i)
      GROUP BY part, m % {entries}, i) GROUP BY part, j) u ON u.part = c{n}.part AND u.j = c{n}.j
)""")
    return "WITH " + ",\n".join(ctes) + f""", coded AS (
  SELECT vec_id, string_agg(lpad(format('{{:x}}', CAST(m % {entries} AS BIGINT)), 2, '0'), '' ORDER BY part) AS code,
         CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT coded.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, j)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""


SQL["op11_ball_codes"] = _ball_codes()

# The polynomial of CRC-32 is a fixed value. A stretch on which words ``q`` apart are the same is
# met through its four-word grams: a run holds two equal ones at distance ``q``.
SQL["op12_periodic_runs"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                                    lambda a, k: xor(a >> 1, 3988292384 * (a & 1))))) AS h
  FROM documents
), u AS (
  SELECT doc_id, w, h, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM t
), d AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1]
         ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END)
    ELSE w END AS w
  FROM u
), x AS MATERIALIZED (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d
), g AS (
  SELECT doc_id, n, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS g
  FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), same AS (
  SELECT l.doc_id, l.i, r.i - l.i AS q FROM g l JOIN g r
    ON l.doc_id = r.doc_id AND l.g = r.g AND r.i > l.i AND 4 * (r.i - l.i) <= l.n AND r.i + 4 <= l.n
), island AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same
), stretch AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 4 + q AS length FROM island GROUP BY doc_id, q, k
), run AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS period FROM stretch
  WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
), best AS (
  SELECT doc_id, count(*) AS n_runs, min({'a': -length, 'b': start, 'c': period}) AS m,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM run GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM x WHERE NOT EXISTS (
    SELECT 1 FROM run r WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length)
  GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(m.b AS BIGINT) AS start, CAST(-m.a AS BIGINT) AS length,
       CAST(m.c AS BIGINT) AS period, CAST(1000 * -m.a // m.c AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
