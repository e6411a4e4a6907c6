"""Constraints that act, and the audit of cells that cannot be assigned."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.operators import expectations as X
from kiln.operators.conform import CELLS, conform, explode_cells, with_cells
from kiln.plans import entities as E
from kiln.schemas import TABLES, Check
from kiln.session import parquet_stage
from tests.conftest import frame


def _fk(column, table, ref):
    return Check("foreign_key", column, ref_table=table, ref_column=ref)


CHECKS = {"a": [Check("not_null", "id"), Check("unique", "id"), Check("range", "v", 0, 10)],
          "b": [Check("unique", "id"), _fk("a_id", "a", "id"), Check("max_len", "t", max_len=3)],
          "c": [_fk("b_id", "b", "id")],
          "d": [_fk("c_id", "c", "id"), _fk("a_id", "a", "id")]}


def _tables(spark):
    return {"a": spark.createDataFrame([("1", 5), ("2", 11), ("3", None), (None, 1), ("4", 3), ("4", 2),
                                        ("5", 99), ("5", 1), ("6", 1), ("6", 1)], "id string, v int"),
            "b": spark.createDataFrame([("x", "1", "ok"), ("y", "2", "ok"), ("z", "9", "ok"), ("w", "1", "long"),
                                        ("n", None, None), ("u", "4", "ok"), ("f", "5", "ok")],
                                       "id string, a_id string, t string"),
            "c": spark.createDataFrame([("c1", "x"), ("c2", "y"), ("c3", "z"), ("c4", "w"), ("c5", None),
                                        ("c6", "f")], "id string, b_id string"),
            "d": spark.createDataFrame([("d1", "c1", "1"), ("d2", "c2", "1"), ("d3", "c4", "2"), ("d4", "c9", "4")],
                                       "id string, c_id string, a_id string")}


def test_quarantine_cascades_to_a_fixpoint(spark):
    tables = _tables(spark)
    found = X.quarantine(tables, CHECKS, parquet_stage)
    kept = {n: sorted((tuple(r) for r in df.collect()), key=str) for n, df in found.kept.items()}
    assert dict(kept["a"]) == {"1": 5, "3": None, "4": 2, "5": 1, "6": 1} and len(kept["a"]) == 5
    assert [r[0] for r in kept["b"]] == ["f", "n", "u", "x"]
    assert [r[0] for r in kept["c"]] == ["c1", "c5", "c6"]
    assert [r[0] for r in kept["d"]] == ["d1"]
    gone = {n: {(r.id, r.reason, r.depth) for r in df.collect()} for n, df in found.rejected.items()}
    assert gone["a"] == {(None, "constraint not_null on id", 0), ("2", "constraint range[0,10] on v", 0),
                         ("5", "constraint range[0,10] on v", 0), ("4", "constraint unique on id", 0),
                         ("6", "constraint unique on id", 0)}
    assert gone["b"] == {("y", "constraint fk:a.id on a_id", 1), ("z", "constraint fk:a.id on a_id", 0),
                         ("w", "constraint max_len3 on t", 0)}
    assert gone["c"] == {("c2", "constraint fk:b.id on b_id", 2), ("c3", "constraint fk:b.id on b_id", 1),
                         ("c4", "constraint fk:b.id on b_id", 1)}
    assert gone["d"] == {("d2", "constraint fk:c.id on c_id", 3), ("d3", "constraint fk:c.id on c_id", 2),
                         ("d4", "constraint fk:c.id on c_id", 0)}
    for n, df in found.kept.items():
        assert X.violations(df, n, CHECKS[n], found.kept).where("violations > 0").count() == 0
        assert tables[n].count() == df.count() + found.rejected[n].count()


def test_quarantine_of_empty_and_single_tables(spark):
    tables = {n: df.limit(0) for n, df in _tables(spark).items()}
    found = X.quarantine(tables, CHECKS, parquet_stage)
    assert all(df.count() == 0 for df in (*found.kept.values(), *found.rejected.values()))
    only = X.quarantine({"b": _tables(spark)["b"]}, {"b": CHECKS["b"]}, parquet_stage)
    assert only.kept["b"].count() == 6                       # no parent table, no reference check


def test_load_order_and_cycles():
    assert X.load_order({n: t.checks for n, t in TABLES.items()}).index("rides") > 1
    with pytest.raises(ValueError):
        X.load_order({"a": [_fk("b_id", "b", "id")], "b": [_fk("a_id", "a", "id")]})


def test_hot_key_and_random_tables_settle(spark):
    rnd = random.Random(7)
    a = [(str(rnd.randint(0, 30)), rnd.randint(-2, 12)) for _ in range(200)] + [("hot", 1)] * 300
    b = [(f"b{i % 90}", rnd.choice(["hot", str(rnd.randint(0, 40))]), "ok") for i in range(300)]
    tables = {"a": spark.createDataFrame(a, "id string, v int"),
              "b": spark.createDataFrame(b, "id string, a_id string, t string")}
    found = X.quarantine(tables, {n: CHECKS[n] for n in "ab"}, parquet_stage)
    good = {i: min(v for j, v in a if j == i and 0 <= v <= 10) for i, v in a if 0 <= v <= 10}
    assert {r.id: r.v for r in found.kept["a"].collect()} == good
    least = {}
    for row in b:
        if row[1] in good:
            least[row[0]] = min(least.get(row[0], row), row)
    assert sorted(tuple(r) for r in found.kept["b"].collect()) == sorted(least.values())


# ------------------------------------------------------------------ cells
USERS = TABLES["users"].bronze_columns


def test_ages_that_no_int_holds_are_audited_and_end_no_run(spark):
    rows = [("1", "a", "m", "abc", "2023-01-01", "x"), ("2", "b", "m", "99999999999", "2023-01-01", "x"),
            ("3", "c", "m", "1e999", "2023-01-01", "x"), ("4", "d", "m", " 41 ", "2023-01-01", "x"),
            ("5", "e", "m", "  ", "2023-01-01", "x"), ("6", "f", "m", None, "2023-01-01", "x"),
            ("7", "g", "m", "-2147483648", "2023-01-01", "x"), ("8", "h", "m", "2147483647.5", "2023-01-01", "x"),
            ("9", "i", "m", "abc", "bad", "x")]
    out = E.clean_users(frame(spark, USERS, rows))
    ages = {r.user_id: r.age for r in out.clean.collect()}
    assert ages == {"1": None, "2": None, "3": None, "4": 41, "5": None, "6": None, "7": -2147483648, "8": None}
    cells = {(r.row_key, r.column_name, r.raw_text, r.target_type, r.problem) for r in out.cells.collect()}
    assert cells == {("1", "age", "abc", "int", "malformed"), ("2", "age", "99999999999", "int", "overflow"),
                     ("3", "age", "1e999", "int", "overflow"), ("8", "age", "2147483647.5", "int", "overflow")}


def test_cells_of_all_tables_and_medians_without_them(spark):
    rides = [("r1", "u", "c", "2023-01-01", "p", "d", "1e999", "12", "ok"),
             ("r2", "u", "c", "2023-01-01", "p", "d", "2", "99999999999", "ok"),
             ("r3", "u", "c", "2023-01-01", "p", "d", "123456.7", "14.5", "ok"),
             ("r4", "u", "c", "2023-01-01", "p", "d", "4", "abc", "ok")]
    u = spark.createDataFrame([("u",)], "user_id string")
    c = spark.createDataFrame([("c",)], "captain_id string")
    out = E.clean_rides(frame(spark, TABLES["rides"].bronze_columns, rides), u, c)
    got = {r.ride_id: (float(r.distance_km), r.duration_min) for r in out.clean.collect()}
    assert got == {"r1": (3.0, 12), "r2": (2.0, 13), "r3": (3.0, 14), "r4": (4.0, 13)}
    assert Counter(r.problem for r in out.cells.collect()) == {"overflow": 3, "malformed": 1}
    pay = [("p1", "r1", "cash", "1e9", "1000", "12d", "-1", "ok"), ("p2", "r1", "cash", "5", None, "", "7", "ok")]
    out = E.clean_payments(frame(spark, TABLES["payments"].bronze_columns, pay), spark.createDataFrame([("r1",)], "ride_id string"))
    assert {(r.row_key, r.column_name, r.problem) for r in out.cells.collect()} == {
        ("p1", "fare", "overflow"), ("p1", "discount_percent", "overflow"), ("p1", "discount_amount", "malformed")}
    cap = [("c1", "n", "abc", "x", "r", "9.99"), ("c2", "n", "1e30", "3", "r", "11")]
    out = E.clean_captains(frame(spark, TABLES["captains"].bronze_columns, cap))
    assert {(r.row_key, r.column_name, r.problem) for r in out.cells.collect()} == {
        ("c1", "age", "malformed"), ("c2", "age", "overflow"), ("c2", "rating", "overflow")}
    assert out.clean.count() == 2


def test_conform_and_cells_agree(spark):
    spec = TABLES["feedback"]
    rows = [(str(i), "r", t, t, "x", "y") for i, t in enumerate(
        ["4.5", "9.94", "9.95", "10", "-3", "1e0", ".5", "5.", "0x1", "1,0", "nan", "inf", "", " ", None, "1e400"])]
    df = with_cells(frame(spark, spec.bronze_columns, rows), spec)
    typed = {r.feedback_id: r.user_rating for r in conform(df, spec).collect()}
    bad = {r.row_key for r in explode_cells(df, "feedback_id", __import__("datetime").datetime(2024, 1, 1)).collect()
           if r.column_name == "user_rating"}
    blank = {"12", "13", "14"}
    assert {k for k, v in typed.items() if v is None} == bad | blank and not bad & blank
    assert df.where(F.size(CELLS) > 0).count() == len(bad)
