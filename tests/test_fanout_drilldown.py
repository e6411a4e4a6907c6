"""Pages of an unmade join, hash-bucket drill-down, co-bucketed joins: results and plans."""

import random
import tempfile
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kiln.operators.aggregates import mode_by, modes_by
from kiln.operators.factorised import factorise, ranked
from kiln.plans import gold as G
from kiln.plans.drilldown import differing_buckets, drill_down
from kiln.session import parquet_stage
from kiln.sources.sinks import write_bucketed


def test_ranked_prefix_sums(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", "a", None]), i, rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i int, w int").repartition(7)
    got, size = ranked(df, [F.col("k").asc_nulls_last(), F.col("i").asc()], F.col("w"), "first", parquet_stage)
    want, at = {}, 0
    for k, i, w in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])):
        want[i], at = at, at + w
    assert {r.i: r["first"] for r in got.collect()} == want and size == at


def test_pages_equal_the_whole_join(spark):
    rnd = random.Random(2)
    left = [(i, rnd.choice(["hot", "b", "c", "none", None])) for i in range(60)]
    right = [("hot", f"h{j:02d}") for j in range(40)] + [("b", "x"), ("b", "y"), ("c", None), (None, "z"), ("d", "q")]
    l, r = spark.createDataFrame(left, "i int, k string"), spark.createDataFrame(right, "k string, v string")
    whole = factorise(l.repartition(5), r.repartition(3), "k", [F.col("i").asc()],
                      [F.col("k").asc(), F.col("v").asc_nulls_last()], parquet_stage)
    want = [(i, k, v) for i, k in left
            for v in ([x for j, x in sorted(right, key=str) if j == k] if k in ("hot", "b", "c") else [None])]
    assert whole.size == len(want)
    for a, b in [(0, 10), (0, whole.size), (37, 38), (whole.size - 5, whole.size + 9), (5, 5)]:
        page = sorted((x.row_no, x.i, x.k, x.v) for x in whole.page(a, b).collect())
        assert page == [(n, *want[n]) for n in range(a, min(b, len(want)))], (a, b)


def _tables(spark):
    rides = [(f"r{i}", f"u{i % 3}", f"c{i % 2}", None, "p", "d", Decimal(i), i, "completed") for i in range(9)]
    return {"users": spark.createDataFrame([(f"u{i}", "n", "m", 1, None, "x") for i in range(4)],
                                           "user_id string, name string, gender string, age int, signup_date date, city string"),
            "rides": spark.createDataFrame(rides, "ride_id string, user_id string, captain_id string, ride_date date, pickup_loc string, "
                                           "drop_loc string, distance_km decimal(7,2), duration_min int, ride_status string"),
            "payments": spark.createDataFrame([(f"p{i}", f"r{i % 4}", "cash", *[Decimal(i)] * 4, "ok") for i in range(7)],
                                              "payment_id string, ride_id string, payment_method string, fare decimal(10,2), "
                                              "discount_percent decimal(5,2), discount_amount decimal(10,2), final_amount decimal(10,2), payment_status string"),
            "feedback": spark.createDataFrame([(f"f{i}", f"r{i % 3}", Decimal(i % 5), Decimal(i % 4), "late", "no") for i in range(5)],
                                              "feedback_id string, ride_id string, user_rating decimal(2,1), captain_rating decimal(2,1), "
                                              "issue_category string, comments string"),
            "captains": spark.createDataFrame([(f"c{i}", "n", 1, None, "x", Decimal("4.5")) for i in range(3)],
                                              "captain_id string, name string, age int, experience_years int, city string, rating decimal(3,2)")}


GOLD = ("users", "rides", "payments", "feedback", "captains")


def test_fanout_pages_of_the_dashboard(spark):
    t = _tables(spark)
    whole = G.dashboard_fanout(*(t[n] for n in GOLD))
    sizes = G.dashboard_fanout_size(*(t[n] for n in GOLD)).agg(F.sum("fanout_rows")).first()[0]
    assert whole.size == sizes + 1                            # one user without a ride
    rows = whole.page(0, whole.size).orderBy("row_no").collect()
    assert [r.row_no for r in rows] == list(range(whole.size))
    users = [r.user_id for r in rows]
    assert users == sorted(users, key=lambda u: (u is None, u or ""))
    assert rows[-1].user_id is None and rows[-1].captain_name == "n" and rows[-1].captain_ride_id is None
    pairs = Counter((r.ride_id, r.captain_ride_id) for r in rows if r.ride_id)
    details = Counter(r.ride_id for r in G.dashboard(*(t[n] for n in GOLD), sort=False).collect() if r.ride_id)
    of = {r.ride_id: r.captain_id for r in t["rides"].collect()}
    assert pairs == Counter({(a, b): n for a, n in details.items() for b in of if of[a] == of[b]})


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_co_bucketed_tables_join_without_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t, root = _tables(spark), tempfile.mkdtemp(prefix="kiln-buckets-")
        b = {n: write_bucketed(t[n], f"{root}/{n}", "ride_id", 4)[0] if n in ("rides", "payments", "feedback") else t[n]
             for n in GOLD}
        joined = b["rides"].join(b["payments"], "ride_id", "left").join(b["feedback"], "ride_id", "left")
        assert _exchanges(joined) == [] and len(_exchanges(
            t["rides"].join(t["payments"], "ride_id", "left").join(t["feedback"], "ride_id", "left"))) == 3
        per_ride = [x for x in _exchanges(G._details(*(b[n] for n in GOLD[:4]))) if "ride_id" in x]
        assert per_ride == []
        assert not [x for x in _exchanges(G.ride_payment_totals(b["payments"]))]
        want = Counter(map(tuple, G.dashboard(*(t[n] for n in GOLD), sort=False).collect()))
        assert Counter(map(tuple, G.dashboard(*(b[n] for n in GOLD), sort=False).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x for x in spark.catalog.listTables() if "kiln_bucketed" in x.name]


def test_plans_read_each_side_few_times(spark):
    """Scans and shuffles of the staged dashboard and the captain aggregate."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = {n: parquet_stage(df) for n, df in _tables(spark).items()}
        details = G._details(*(t[n] for n in GOLD[:4]))
        plan = details._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 6 and plan.count("Exchange hashpartitioning") <= 8
        plan = G.captain_aggregate(t["captains"], *(t[n] for n in GOLD[1:4]))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_modes_of_several_columns(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("xyz"), rnd.choice(["a", "b", None]), rnd.choice(["p", "q", "r", None])) for _ in range(200)]
    df = spark.createDataFrame([*rows, ("w", None, None), ("v", None, "p")], "k string, a string, b string")
    got = {r.k: (r.ma, r.mb) for r in modes_by(df, "k", {"a": "ma", "b": "mb"}).collect()}
    a = {r.k: r.a for r in mode_by(df, ["k"], "a").collect()}
    b = {r.k: r.b for r in mode_by(df, ["k"], "b").collect()}
    assert got == {k: (a.get(k), b.get(k)) for k in set(a) | set(b)}


# ------------------------------------------------------------------ drill-down
def _sides(n=400):
    rnd = random.Random(6)
    left = {f"k{i}": (Decimal(rnd.randint(0, 10 ** 6)) / 100, rnd.randint(0, 9)) for i in range(n)}
    left["null sum"] = (None, 1)
    right = dict(left)
    right["k1"] = (left["k1"][0] + 5, left["k1"][1])
    right["k2"] = (left["k2"][0] - 5, left["k2"][1])          # cancels out in the total
    right["k3"] = (None, left["k3"][1])
    del right["k4"]
    right["new"] = (Decimal(1), 0)
    return left, right


@pytest.mark.parametrize("bits, levels", [(12, 2), (1, 1), (2, 4)])
def test_drill_down_finds_planted_differences(spark, bits, levels):
    left, right = _sides()
    frame = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], "k string, m decimal(12,2), n int")
    got = {(r.row_key, r.measure): (r.left_value, r.right_value, r.difference) for r in drill_down(
        frame(left), frame(right), "k", ["m", "n"], parquet_stage, bits, levels).collect()}
    want = {("k1", "m"): -5, ("k2", "m"): 5, ("k3", "m"): None}
    want |= {(k, m): None for k in ("k4", "new") for m in ("rows", "m", "n")}
    assert {k: v[2] for k, v in got.items()} == want
    assert got["k4", "m"][:2] == (left["k4"][0], None) and got["new", "rows"][:2] == (None, 1)


def test_equal_buckets_are_not_opened(spark):
    left, right = _sides()
    from kiln.plans.drilldown import _side
    frame = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], "k string, m decimal(12,2), n int")
    a, b = (_side(frame(d), "k", ["m", "n"]) for d in (left, right))
    assert differing_buckets(a, b, 0, 12).count() <= 5 and differing_buckets(a, a, 0, 12).count() == 0
    assert drill_down(frame(left), frame(left), "k", ["m", "n"], parquet_stage).count() == 0


def test_drill_down_of_repeated_null_and_no_keys(spark):
    schema = "k string, m int"
    a = spark.createDataFrame([(None, 1), (None, 2), ("x", 1), ("x", 1)], schema)
    b = spark.createDataFrame([(None, 3), ("x", 2)], schema)
    got = {(r.row_key, r.measure): float(r.difference) for r in drill_down(a, b, "k", ["m"], parquet_stage).collect()}
    assert got == {(None, "rows"): 1.0, ("x", "rows"): 1.0}
    assert {r.row_key for r in drill_down(a, b.limit(0), "k", ["m"], parquet_stage).collect()} == {None, "x"}
