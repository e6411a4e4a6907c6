"""URL allow and block rules by a sort-merge range join.

A rule is a (host, path) pair. It covers its host and every subdomain, for urls whose
path starts with the rule's path. Hosts are written with their labels reversed
(``www.example.com`` -> ``com.example.www``), so one rule is one interval of the sorted
(reversed host, path) keys. A url probes the key of each of its parent hosts; probes and
interval starts are swept together in sorted order with a stack of the rules that are
open at that point. Rules that share a host nest, so the top of the stack that still
covers the probe is the longest one.

Two ways to bring rules and urls together, same sweep:

* up to ``broadcast_rules`` rules (counted first): each task sweeps its own urls against
  all rules, nothing is shuffled;
* more: keys are cut into ranges at boundaries taken from a bounded sample of urls, a
  rule goes to every range it overlaps, probes are dealt by range (a key so frequent that
  it fills several ranges is spread over all of them), and ranges are swept one by one.

Defined results: null urls and urls without ``://`` have empty host and path, and no
rule; the rule with the longest host + path text wins, then the longer host; of equal
rules with different verdicts ``block`` wins; null rule hosts or paths count as empty,
and a rule with an empty host covers nothing. Repeated rows are judged one by one. A very
long host is probed only at the depths that rules have.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.store import Stage

def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: str) -> str:
    return ".".join(reversed(host.split(".")))


def probe_keys(host: str, path: str, depths: list[int]) -> list[tuple[str, str]]:
    """The (reversed host, path) keys of the host and its parent hosts with as many labels as
    some rule has (``depths``, ascending): what a long host costs depends on the rules alone."""
    if not host or not depths:
        return []
    # the last labels of the host, no more than the deepest rule has
    labels = host.rsplit(".", depths[-1])[-depths[-1]:][::-1]
    return [(".".join(labels[:n]), path) for n in depths if n <= len(labels)]


def sort_rules(rows: list[tuple]) -> list[tuple[str, str, str, str]]:
    """(host, path, verdict) rows as sorted (reversed host, path, verdict, rule text)."""
    best: dict[tuple[str, str], tuple[str, str]] = {}
    for host, path, verdict in rows:
        host, path = host or "", path or ""
        if host:
            key = (reversed_host(host), path)
            if key not in best or verdict == "block":
                best[key] = (verdict, host + path)
    return [(*k, *v) for k, v in sorted(best.items())]


def sweep(rules: list[tuple[str, str, str, str]], probes: list[tuple[str, str, int]],
          keep) -> None:
    """Merge sorted rules and sorted (reversed host, path, id) probes; ``keep(id, rule)``
    is told the innermost rule open at each probe."""
    stack: list[tuple[str, str, str, str]] = []
    at, n = 0, len(rules)
    for host, path, row in probes:
        while at < n and rules[at][:2] <= (host, path):
            rule = rules[at]
            while stack and not (stack[-1][0] == rule[0] and rule[1].startswith(stack[-1][1])):
                stack.pop()
            stack.append(rule)
            at += 1
        while stack and not (stack[-1][0] == host and path.startswith(stack[-1][1])):
            stack.pop()
        if stack:
            keep(row, stack[-1])


def _longer(a, b):
    """Of two fitting rules the longer text, then the longer host."""
    return a if b is None or (len(a[3]), len(a[0])) > (len(b[3]), len(b[0])) else b


def _judge_batches(rules):
    depths = sorted({r[0].count(".") + 1 for r in rules})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            best: list = [None] * len(hosts)

            def keep(row, rule):
                best[row] = _longer(rule, best[row])

            probes = sorted((*k, i) for i, (h, p) in enumerate(zip(hosts, paths))
                            for k in probe_keys(h, p, depths))
            sweep(rules, probes, keep)
            cols = [batch.column(c) for c in ("page_id", "host", "path")]
            cols.append(pa.array([b and b[3] for b in best], pa.string()))
            cols.append(pa.array([b and b[2] for b in best], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "host", "path", "rule", "hit"])
    return judge


def _by_range(parts: DataFrame, rules: DataFrame, ranges: int, sample_rows: int) -> DataFrame:
    """Longest rule per row id through a range-partitioned sweep (rules of any number)."""
    spark = parts.sparkSession
    stage = Stage(spark, "url-rules")
    ids = stage.put(parts.withColumn("row", F.monotonically_increasing_id()), "urls")
    labels = F.size(F.split("host", r"[.]"))
    # one number for each depth that rules have
    depths = sorted(r[0] for r in rules.filter("host <> ''").select(labels).distinct().collect())

    def explode(batches):
        for b in batches:
            out = [(r, *k) for r, h, p in zip(b.column("row").to_pylist(),
                                             b.column("host").to_pylist(),
                                             b.column("path").to_pylist())
                   for k in probe_keys(h, p, depths)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.string())], ["row", "rhost", "path"])

    probes = ids.select("row", "host", "path").mapInArrow(
        explode, "row long, rhost string, path string")
    total = max(1, ids.count())
    share = min(1.0, sample_rows / total)
    seen = sorted((r.rhost, r.path) for r in probes.sample(share, seed=7)
                  .select("rhost", "path").limit(4 * sample_rows).collect())
    step = max(1, len(seen) // ranges)
    cuts = seen[step::step]

    def deal_probes(batches):
        for b in batches:
            rows = b.column("row").to_pylist()
            keys = list(zip(b.column("rhost").to_pylist(), b.column("path").to_pylist()))
            pid = []
            for r, k in zip(rows, keys):
                lo, hi = bisect_left(cuts, k), bisect_right(cuts, k)
                pid.append(lo + r % (hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pid, pa.int32()), b.column("row"), b.column("rhost"),
                 b.column("path"), pa.nulls(len(rows), pa.string()),
                 pa.nulls(len(rows), pa.string())],
                ["pid", "row", "rhost", "path", "hit", "rule"])

    def deal_rules(batches):
        for b in batches:
            rows = []
            for h, p, v in zip(*(b.column(c).to_pylist() for c in ("host", "path", "verdict"))):
                for rhost, path, verdict, text in sort_rules([(h, p, v)]):
                    lo = bisect_left(cuts, (rhost, path))
                    hi = bisect_right(cuts, (rhost, path + "\U0010ffff"))
                    rows += [(pid, None, rhost, path, verdict, text)
                             for pid in range(lo, hi + 1)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("pid", "row", "rhost", "path", "hit", "rule"), r)) for r in rows],
                pa.schema([("pid", pa.int32()), ("row", pa.int64()), ("rhost", pa.string()),
                           ("path", pa.string()), ("hit", pa.string()), ("rule", pa.string())]))

    schema = "pid int, row long, rhost string, path string, hit string, rule string"
    dealt = (probes.mapInArrow(deal_probes, schema)
             .unionByName(rules.select("host", "path", "verdict").mapInArrow(deal_rules, schema))
             .repartition(len(cuts) + 1, "pid")
             # rules sort before probes of the same key; block last, so that it ends on top
             .sortWithinPartitions("pid", "rhost", "path", F.col("row").asc_nulls_first(),
                                   F.col("hit").asc()))

    def swept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, str, str, str]] = []
        here = None
        for f in frames:
            rows, hits, texts, hosts = [], [], [], []
            for pid, row, rhost, path, hit, rule in zip(
                    f.pid, f.row, f.rhost, f.path, f.hit, f.rule):
                if pid != here:
                    here, stack = pid, []
                while stack and not (stack[-1][0] == rhost and path.startswith(stack[-1][1])):
                    stack.pop()
                if rule is not None:
                    if not (stack and stack[-1][:2] == (rhost, path) and stack[-1][2] == "block"):
                        stack.append((rhost, path, hit, rule))
                elif stack:
                    rows.append(int(row))
                    hits.append(stack[-1][2])
                    texts.append(stack[-1][3])
                    hosts.append(len(stack[-1][0]))
            if rows:
                yield pd.DataFrame({"row": pd.array(rows, dtype="int64"),
                                    "hit": pd.Series(hits, dtype=object),
                                    "rule": pd.Series(texts, dtype=object),
                                    "host_chars": pd.array(hosts, dtype="int64")})

    found = dealt.mapInPandas(swept, "row long, hit string, rule string, host_chars long")
    # all rules that fit one url lie on its chain of parent hosts, as in _longer
    longest = found.groupBy("row").agg(
        F.max_by(F.struct("rule", "hit"), F.struct(F.length("rule"), "host_chars")).alias("best"))
    return (ids.join(longest, "row", "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.col("best.hit").alias("hit")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id",
               url_col: str = "url", default: str = "allow",
               broadcast_rules: int = 100_000, ranges: int | None = None,
               sample_rows: int = 20_000) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``."""
    parts = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"))
    few = rules.select("host", "path", "verdict").limit(broadcast_rules + 1).collect()
    if len(few) <= broadcast_rules:
        schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()),
                               T.StructField("hit", T.StringType())])
        out = parts.mapInArrow(_judge_batches(sort_rules([tuple(r) for r in few])), schema)
    else:
        spark = pages.sparkSession
        ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        out = _by_range(parts, rules, ranges, sample_rows)
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("hit", F.lit(default)).alias("verdict"))
