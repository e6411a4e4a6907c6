"""Full refresh that is seen whole or not at all; what writes observe; runs from CSV files."""

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kiln.operators.expectations import ExpectationError
from kiln.plans import reconcile as R
from kiln.plans.pipeline import PipelineConfig, run
from kiln.schemas import TABLES
from kiln.sources.sinks import LayerRun, layer_tables, read_layer, table_path, write_observed


def _dir(name):
    return tempfile.mkdtemp(prefix=f"kiln-{name}-")


def test_a_killed_write_leaves_the_previous_layer(spark):
    root = _dir("wh")
    first = LayerRun(spark, root, "gold", "1")
    assert first.write(spark.range(10), "t")["rows"] == 10
    with pytest.raises(FileNotFoundError):
        read_layer(spark, root, "gold", "t")              # nothing is seen before it is published
    first.write(spark.range(3), "other")
    first.publish()
    second = LayerRun(spark, root, "gold", "2")
    second.write(spark.range(5), "other")
    # the write of t dies in one of its tasks, after others have written their files
    torn = spark.range(0, 1000, 1, 8).withColumn("x", F.when(F.col("id") < 900, 1).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        second.write(torn, "t")
    assert read_layer(spark, root, "gold", "t").count() == 10
    assert read_layer(spark, root, "gold", "other").count() == 3
    assert layer_tables(spark, root, "gold") == ["other", "t"]
    third = LayerRun(spark, root, "gold", "2")
    third.write(spark.range(7), "t")
    third.publish()
    assert read_layer(spark, root, "gold", "t").count() == 7 and layer_tables(spark, root, "gold") == ["t"]
    kept = [n for n in os.listdir(os.path.join(root, "gold")) if n.startswith("run-")]
    assert sorted(kept) == sorted([first.run, third.run])    # the torn run is gone, the previous stays


def test_writes_observe_metrics(spark):
    df = spark.createDataFrame([("a", Decimal("0.10")), ("b", Decimal("0.20")), ("a", None)], "k string, v decimal(10,2)")
    seen = write_observed(df.repartition(3), _dir("t"), {"total": F.sum("v"), "n": F.count("v")})
    assert seen == {"rows": 3, "total": Decimal("0.30"), "n": 2}
    empty = write_observed(df.limit(0), _dir("t"), {"total": F.sum("v")}, mode="append")
    assert empty["rows"] == 0 and empty.get("total") is None


def test_most_common_counts_when_there_are_too_many_categories(monkeypatch):
    rows = [{"item": "b", "count": 3}, {"item": "a", "count": 3}, {"item": None, "count": 9}, {"item": "c", "count": 1}]
    assert R.most_common(rows, lambda: "counted") == "a"
    assert R.most_common(None, lambda: "counted") is None
    monkeypatch.setattr(R, "ISSUE_CATEGORIES", 4)
    assert R.most_common(rows, lambda: "counted") == "counted"


CSV = {
    "users": ["u1,Ann,f,30,2023-01-05,Rome", "u2,Bob,m,abc,05/01/2023,Oslo", "u3,Cid,m,99999999999,2023-02-01,Rome",
              "u4,Dan,m,20,never,Rome", "u5,Eve,f,33,2023-03-01,Rome,EXTRA", "u6,Flo,f,35,2023-03-01"],
    "captains": ["c1,Kim,40,3,Rome,4.5", "c2,Lou,,2,Oslo,", "c3,,50,1,Rome,4.0"],
    "rides": ["r1,u1,c1,2023-04-01,A,B,10.5,20,completed", "r2,u2,c2,2023-04-02,A,B,,30,cancelled",
              "r3,u3,c1,2023-04-03,A,B,7,NA,", "r4,u9,c1,2023-04-03,A,B,7,5,completed",
              "r5,u6,c2,2023-04-03,A,B,-1,5,completed"],
    "payments": ["p1,r1,cash,100,10,10,90,paid", "p2,r2,card,50,0,0,50,paid", "p3,r4,cash,5,0,0,5,paid",
                 "p4,r5,cash,8,0,0,8,paid", "p2,r3,card,60,0,0,60,paid",
                 "p5,r3,cash,10,0,0,10,paid"],
    "feedback": ['f1,r1,5,4,late,"said ""hi, there"" ok\nline two"', "f2,r2,,3,,", "f3,r5,2,2,rude,no"]}


def _landing(files=None):
    d = _dir("csv")
    for name, rows in {**CSV, **(files or {})}.items():
        os.makedirs(os.path.join(d, f"{name}.csv"))
        columns = TABLES[name].bronze_columns
        with open(os.path.join(d, f"{name}.csv", "a.csv"), "w") as f:
            f.write("\n".join([",".join(columns), *rows[:2]]) + "\n")
        if name != "feedback":                       # a second file with the columns the other way round
            with open(os.path.join(d, f"{name}.csv", "b.csv"), "w") as f:
                split = [r.split(",") for r in rows[2:]]
                f.write("\n".join([",".join(columns[::-1])] + [
                    ",".join(r[:len(columns)][::-1] + r[len(columns):]) if len(r) >= len(columns)
                    else ",".join(([""] * (len(columns) - len(r)) + r[::-1])) for r in split]) + "\n")
        else:
            with open(os.path.join(d, f"{name}.csv", "a.csv"), "a") as f:
                f.write("\n".join(rows[2:]) + "\n")
    return d


def test_a_run_from_five_csv_files(spark):
    root, land = _dir("wh"), _landing()
    with pytest.raises(ExpectationError, match="payments.payment_id unique=2"):
        run(spark, PipelineConfig(root=root, raw_dir=land, as_of="2023-04-10"))
    assert layer_tables(spark, root, "silver") == []       # the failed run published nothing
    out = run(spark, PipelineConfig(root=root, raw_dir=land, as_of="2023-04-10", constraints="quarantine",
                                    export_dir=os.path.join(root, "export")))
    read = lambda layer, t: read_layer(spark, root, layer, t)
    assert {r.user_id: r.age for r in read("silver", "users").collect()} == {
        "u1": 30, "u2": None, "u3": None, "u6": 35}
    assert {r.ride_id for r in read("silver", "rides").collect()} == {"r1", "r2", "r3"}
    assert {r.payment_id: float(r.final_amount) for r in read("silver", "payments").collect()} == {
        "p1": 90.0, "p2": 50.0, "p5": 10.0}
    assert read("silver", "feedback").where("feedback_id = 'f1'").first().comments == 'said "hi, there" ok\nline two'
    why = {(r.ride_id, r.reason) for r in read("audit", "rides").collect()}
    assert why == {("r4", "invalid_user_id_not_in_users"), ("r5", "constraint range[0, on distance_km")}
    assert {r.payment_id for r in read("audit", "payments").collect()} == {"p2", "p3", "p4"}
    assert {r.feedback_id for r in read("audit", "feedback").collect()} == {"f3"}
    lines = {(r.problem, r.loaded) for r in read("audit", "users_lines").collect()}
    assert lines == {("surplus_cells", False)}
    assert {r.raw_text for r in read("audit", "users_cells").collect()} == {"abc", "99999999999"}
    rep = {(r.entity, r.metric): r for r in spark.read.parquet(out["report"]).collect()}
    assert rep["User", "total_revenue"].silver_value == 150 and rep["User", "is_active"].silver_value == 3
    assert rep["User", "most_frequent_issue"].silver_text == "No issues"
    assert all(r.status == "OK" for (_, m), r in rep.items() if m != "most_frequent_issue")
    with open(os.path.join(table_path(spark, root, "reports", "reconciliation_csv"), next(
            f for f in os.listdir(table_path(spark, root, "reports", "reconciliation_csv")) if f.startswith("part")))) as f:
        metrics = [line.split(",")[0] for line in f.read().splitlines()]
    assert metrics == ["Metric", *R.USER_METRICS, *R.CAPTAIN_METRICS]


def test_a_failed_run_keeps_the_layers_of_the_one_before(spark):
    root = _dir("wh")
    good = {"payments": CSV["payments"][:4]}
    cfg = dict(root=root, raw_dir=_landing({**good, "rides": CSV["rides"][:4], "users": CSV["users"][:4]}),
               as_of="2023-04-10", dashboard=False)
    run(spark, PipelineConfig(**cfg))
    before = {t: table_path(spark, root, "gold", t) for t in layer_tables(spark, root, "gold")}
    with pytest.raises(ExpectationError):
        run(spark, PipelineConfig(**{**cfg, "raw_dir": _landing()}))
    assert {t: table_path(spark, root, "gold", t) for t in layer_tables(spark, root, "gold")} == before
    assert read_layer(spark, root, "gold", "user_aggregate").count() == 3
