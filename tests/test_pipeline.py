import os
import random
import tempfile

from pyspark.sql import functions as F

from kiln.plans.pipeline import PipelineConfig, register_layers, run
from kiln.schemas import TABLES
from kiln.sources.sinks import table_path
from kiln.streaming import ingest_landing, read_bronze
from kiln.streaming.bronze_ingest import read_line_audit
from kiln.streaming.keep_first import keep_first_stream, read_first
from tests.conftest import SF001


def test_pipeline_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="kiln-wh-")
    out = run(spark, PipelineConfig(root=root, sf_dir=SF001, as_of="2001-08-01", constraints="quarantine",
                                    export_dir=os.path.join(root, "export")))
    c = out["counts"]
    assert c["silver.rides"] > 0 and c["gold.captain_aggregate"] == c["silver.captains"]
    assert c["gold.user_aggregate"] == c["silver.users"]
    rep = spark.read.parquet(out["report"])
    assert rep.count() == 15
    csv = spark.read.option("header", True).csv(table_path(spark, root, "reports", "reconciliation_csv"))
    assert csv.columns == ["Metric", "Silver", "Gold", "Difference", "Status", "Entity"]
    assert spark.read.option("header", True).csv(os.path.join(root, "export", "captains_data")).count() \
        == c["silver.captains"]
    views = register_layers(spark, root)
    assert "gold_captain_aggregate" in views and "audit_rides" in views
    n = spark.sql("SELECT SUM(total_rides) AS n FROM gold_captain_aggregate").first()["n"]
    assert n == c["silver.rides"]


def test_streaming_ingest_is_incremental(spark):
    land = tempfile.mkdtemp(prefix="kiln-land-")
    bronze = tempfile.mkdtemp(prefix="kiln-bronze-")
    spec = TABLES["users"]
    os.makedirs(os.path.join(land, "users"))
    header = ",".join(spec.bronze_columns) + "\n"
    with open(os.path.join(land, "users", "a.csv"), "w") as f:
        f.write(header + "1,a,M,20,2023-01-01,X\n2,b,F,NA,2023-01-02,Y\n")
    assert ingest_landing(spark, land, bronze, spec) == 1
    assert ingest_landing(spark, land, bronze, spec) == 0      # nothing new: no duplicates
    with open(os.path.join(land, "users", "b.csv"), "w") as f:
        f.write(header + "3,c,M,30,2023-01-03,Z\n")
    assert ingest_landing(spark, land, bronze, spec) == 1
    df = read_bronze(spark, bronze, spec)
    assert df.count() == 3
    assert df.where(F.col("user_id") == "2").first()["age"] is None
    firsts = [r["user_id"] for r in df.orderBy("_seq").collect()]
    assert firsts == ["1", "2", "3"]


def _land(land, name, text):
    os.makedirs(os.path.join(land, "feedback"), exist_ok=True)
    with open(os.path.join(land, "feedback", name), "w") as f:
        f.write(text)


def test_streaming_ingest_reads_like_the_batch_reader(spark):
    land, bronze, spec = tempfile.mkdtemp(prefix="kiln-land-"), tempfile.mkdtemp(prefix="kiln-bronze-"), TABLES["feedback"]
    _land(land, "a.csv", "comments,issue_category,captain_rating,user_rating,ride_id,feedback_id\n"
                         '"said ""hi, there""",late,1,2,r1,f1\nx,y,3,4,r2,f2,EXTRA\n')
    _land(land, "b.csv", "feedback_id,ride_id,user_rating,captain_rating,issue_category,comments\nf3,r3,NA,5,z\n")
    _land(land, "empty.csv", "")
    assert ingest_landing(spark, land, bronze, spec) == 1
    assert ingest_landing(spark, land, bronze, spec) == 0
    rows = {r.feedback_id: r for r in read_bronze(spark, bronze, spec).collect()}
    assert set(rows) == {"f1", "f3"} and rows["f1"].comments == 'said "hi, there"' and rows["f1"].ride_id == "r1"
    assert rows["f3"].user_rating is None and rows["f3"].comments is None
    audit = {(r.raw_line, r.problem, r.loaded) for r in read_line_audit(spark, bronze, spec).collect()}
    assert audit == {("x,y,3,4,r2,f2,EXTRA", "surplus_cells", False), ("f3,r3,NA,5,z", "short_line", True)}


def test_keep_first_over_three_batches_equals_one(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", None, *"abcdefgh"]), rnd.randint(0, 50), rnd.randint(0, 3)) for _ in range(300)]
    schema = "k string, at int, v int"

    def stream(batches):
        land, out = tempfile.mkdtemp(prefix="kiln-land-"), tempfile.mkdtemp(prefix="kiln-first-")
        n = 0
        for part in batches:                       # every call is a session of its own that goes on
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(land)
            n += keep_first_stream(spark.readStream.schema(schema).parquet(land), ["k"], ["at"], out)
        assert keep_first_stream(spark.readStream.schema(schema).parquet(land), ["k"], ["at"], out) == 0
        return n, sorted((tuple(r) for r in read_first(spark, out, ["k"]).collect()), key=str)
    late_first = sorted(rows, key=lambda r: -r[1])      # the first rows by order land last
    three, got = stream([late_first[:100], late_first[100:200], late_first[200:]])
    one, want = stream([rows])
    least = {k: (k, *min((a, v) for j, a, v in rows if j == k), sum(j == k for j, _, _ in rows)) for k, _, _ in rows}
    assert got == want == sorted(least.values(), key=str) and (three, one) == (3, 1)
