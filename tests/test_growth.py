"""Forms that keep the cost a row low on large tables: what they give, and that plans have them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.exprs import RIDES_DATE_FORMATS, USERS_DATE_FORMATS, is_blank, parse_date, strip_ws, to_number
from kiln.operators.conform import assign, number_for, plain_number, with_cells
from kiln.operators.quarantine import reject_orphans, start
from kiln.plans import catalog as C
from kiln.plans import entities as E
from kiln.plans import gold as G
from kiln.schemas import TABLES
from kiln.sources import testdata as TD
from tests.conftest import frame

DATES = ["2000-1-1", "2000-02-30", "0000-01-01", "0099-12-31", "+12345-1-2", "12345-1-2", "2000-001-01", "2000-1-1\n",
         " 2000-1-1 ", "2000-1", "31/12/1999", "12/31/1999", "31.12.1999", "12-31-1999", "1/2/0000", "01/02/+12345",
         "", "bad", None, "1/2/99", "29/2/1900", "29.2.2000", "2000--1-1", "2000/1/1", "2000-1-1T00:00"]
NUMBERS = ["1", "9.9", "9.95", "10", "5.", ".5", "-1", "+1", "1e1", "99999999.99", "99999999.994", "99999999.995",
           "9999999.999999", "2147483647", "2147483648", "999999999.5", "0.5", "2.5", " 7 ", "7\n", "abc", "", "  ",
           None, "1e999", "12d", "nan", "999.994", "999.995", "99999.995"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("layouts", [USERS_DATE_FORMATS, RIDES_DATE_FORMATS])
def test_dates_are_what_the_formatter_reads(spark, layouts):
    df = frame(spark, ["x"], [(v,) for v in DATES])
    whole = F.coalesce(*[F.try_to_date("x", f) for f in layouts])
    rows = df.select("x", parse_date("x", layouts).cast("string").alias("a"), whole.cast("string").alias("b"))
    assert [r for r in rows.collect() if r.a != r.b] == []
    assert "RLIKE" in _plan(rows.select("a"))  # the formatter sees only text of its layout


@pytest.mark.parametrize("target", [T.IntegerType(), T.DecimalType(2, 1), T.DecimalType(5, 2), T.DecimalType(10, 2)])
def test_plain_numbers_are_judged_alike(spark, target):
    df = frame(spark, ["x"], [(v,) for v in NUMBERS])
    v = to_number("x")
    rows = df.select("x", number_for("x", target).alias("a"), F.when(assign(v, target).isNotNull(), v).alias("b"),
                     plain_number("x", target).alias("plain"), is_blank("x").alias("blank"),
                     (F.col("x").isNull() | (strip_ws("x") == "")).alias("was_blank")).collect()
    assert [r for r in rows if r.a != r.b or (r.plain and r.b is None) or r.blank != r.was_blank] == []
    assert any(r.plain for r in rows)


def test_bronze_rides_read_their_tables_once(spark, tmp_path):
    day = dt.date(1995, 1, 2)
    spark.createDataFrame([(k, 7, "F", 10.0, day, "1-URGENT") for k in (1, 53, 106)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate date, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(53, 3, 1), (53, 2, 2), (1, 4, 1)], "l_orderkey long, l_suppkey long, l_linenumber long") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    rides = TD.bronze_rides(spark, str(tmp_path))
    assert _plan(rides).count("FileScan") == 2
    got = sorted((r._seq, r.captain_id, r.ride_status, r.duration_min) for r in rides.collect())
    assert got == [(1, "4", "completed", "1"), (53, "2", "completed", "3"), (106, None, "completed", None),
                   (53 + TD.COPY_OFFSET, "2", "completed", "3"), (106 + TD.COPY_OFFSET, None, "completed", None)]


def test_rows_are_not_sorted_for_a_large_key_set(spark):
    df = start(frame(spark, ["k"], [("a",), ("b",), (None,), ("a",), ("c",)]))
    keys = frame(spark, ["key"], [("a",), ("c",), (None,), ("a",)])
    got = reject_orphans(df, "k", keys, "key", "orphan", many_keys=True)
    assert "SortMergeJoin" not in _plan(got) and "ShuffledHashJoin" in _plan(got)
    assert sorted((r._seq, r.reason) for r in got.collect()) == [
        (0, None), (1, "orphan"), (2, "orphan"), (3, None), (4, None)]


def test_incremental_batches_land_from_all_tasks(spark, tmp_path, monkeypatch):
    columns = ("l_orderkey long, l_linenumber long, l_extendedprice double, l_partkey long, l_suppkey long, "
               "l_quantity double, l_shipdate date")
    rows = [(k % 150, 1, float(k), k, 1, 1.0, dt.date(1995, 1, 2)) for k in range(400)]
    spark.createDataFrame(rows, columns).repartition(8).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr(C, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    got = C.q_dedupe_incremental(spark, f"{tmp_path}/in").collect()
    assert sorted((r.l_orderkey, r.l_extendedprice) for r in got) == [(k, float(k)) for k in range(150)]
    parts = [f for f in os.listdir(f"{tmp_path}/landed-lines") if f.endswith(".parquet")]
    assert len(parts) > 8  # two tasks a batch wrote 8 at most


def test_odd_cells_are_judged_apart(spark):
    """Numbers and cells of payments as the regexes and casts over every cell give them, in a plan that
    casts plain cells as they are."""
    spec = TABLES["payments"]
    df = frame(spark, [c for c in spec.bronze_columns], [
        (str(i), "r", "m", v, w, v, w, "s") for i, (v, w) in enumerate(zip(NUMBERS, reversed(NUMBERS)))])
    kinds, numbers = dict(spec.silver_types), ["fare", "discount_percent", "discount_amount", "final_amount"]
    out = with_cells(df, spec, numbers={c: f"n_{c}" for c in numbers}, assigned={c: f"a_{c}" for c in numbers})
    for r in out.select("*", *[x for c in numbers for x in (
            F.when(assign(to_number(c), kinds[c]).isNotNull(), to_number(c)).alias(f"want_n_{c}"),
            assign(to_number(c), kinds[c]).alias(f"want_a_{c}"))]).collect():
        problems = {}
        for c in numbers:
            assert (r[f"n_{c}"], r[f"a_{c}"]) == (r[f"want_n_{c}"], r[f"want_a_{c}"])
            if r[c] is not None and r[c].strip() and r[f"want_a_{c}"] is None:
                problems[c] = r[c]
        assert {e.column_name: e.raw_text for e in r["_cells"]} == problems
        assert {e.problem for e in r["_cells"] if e.raw_text.strip() == "1e999"} <= {"malformed", "overflow"}
    assert "transform" in _plan(out)  # odd cells only


def test_cleaned_payments_are_staged_typed(spark):
    """Reading clean payments casts no text again, and rows that stay carry no second copy of it."""
    staged = []

    def stage(df):
        staged.append(E.parquet_stage(df))
        return staged[-1]
    rides = frame(spark, ["ride_id"], [("r",)])
    rows = [("1", "r", "m", "9.999", "abc", None, "7", "s"), ("2", "gone", "m", "12d", "5", "6", "7", "s")]
    out = E.clean_payments(frame(spark, TABLES["payments"].bronze_columns, rows), rides, dt.datetime(2001, 1, 1), stage)
    [r] = out.clean.collect()
    assert [str(r[c]) for c in ("fare", "discount_percent", "discount_amount", "final_amount")] == [
        "10.00", "0.00", "0.00", "7.00"]
    assert "RLIKE" not in _plan(out.clean)
    [bad] = out.rejects.collect()
    assert (bad.fare, bad.discount_percent, bad.final_amount) == ("12d", "5", "7")
    assert [(c.row_key, c.raw_text) for c in out.cells.collect()] == [("1", "abc")]
    assert [x.fare for x in staged[-1].where("payment_id = '1'").collect()] == [None]


def test_users_meet_rides_before_the_details(spark):
    users = frame(spark, ["user_id", "name", "gender", "age", "signup_date", "city"],
                  [(u, u, "g", "1", "d", "c") for u in ("a", "b", "c")], seq=False)
    rides = frame(spark, ["ride_id", "user_id", "captain_id", "ride_date", "pickup_loc", "drop_loc", "distance_km",
                          "duration_min", "ride_status"],
                  [(str(i), u, "k", "d", "p", "q", "1", "2", "s") for i, u in enumerate(["a", "a", "b", None, "x"])],
                  seq=False)
    payments = frame(spark, TABLES["payments"].bronze_columns,
                     [(str(i), r, "m", "1", "2", "3", "4", "s") for i, r in enumerate(["0", "0", "2", "3", None])], seq=False)
    feedback = frame(spark, TABLES["feedback"].bronze_columns,
                     [(str(i), r, "1", "2", "i", "c") for i, r in enumerate(["0", "0", "1", None])], seq=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        late, early = (G._details(users, rides, payments, feedback, users_first=x) for x in (False, True))
        assert late.columns == early.columns
        assert sorted(map(str, late.collect())) == sorted(map(str, early.collect()))
        by_user = [x for x in _plan(early).splitlines() if "Exchange hashpartitioning(user_id" in x]
        assert by_user and early.where("user_id = 'a'").count() == 5
        joins = [x.strip(" :+-") for x in _plan(early).splitlines() if "Join [user_id" in x and "Inner" in x]
        payment_join = _plan(early).index("Join [ride_id")
        assert joins and _plan(early).index("Join [user_id") > payment_join  # below it: done before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
