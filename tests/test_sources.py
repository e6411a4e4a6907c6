import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kiln.operators.expectations import ExpectationError, enforce
from kiln.schemas import TABLES
from kiln.sources.csv import (
    SHORT, SURPLUS, MissingSourceError, line_audit, loaded, normalise_nulls, read_lines, read_raw_csv,
)


def _write(text):
    d = tempfile.mkdtemp(prefix="kiln-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_null_tokens_and_order(spark):
    p = _write('ride_id,user_id,captain_id,ride_date,pickup_loc,drop_loc,distance_km,duration_min,ride_status\n'
               'r1,NA,null,2023-01-01,,"",nan,N/A,done\n'
               'r2,u2,c2,2023-01-02, x ,y,1,2,ok\n')
    df = read_raw_csv(spark, p, TABLES["rides"].bronze_schema())
    rows = df.orderBy("_seq").collect()
    assert [r["ride_id"] for r in rows] == ["r1", "r2"]
    r1 = rows[0]
    assert r1["user_id"] is None and r1["captain_id"] is None and r1["pickup_loc"] is None
    assert r1["drop_loc"] is None and r1["distance_km"] is None and r1["duration_min"] is None
    assert rows[1]["pickup_loc"] == " x "


def test_header_only_and_missing(spark):
    p = _write("user_id,name,gender,age,signup_date,city\n")
    df = read_raw_csv(spark, p, TABLES["users"].bronze_schema())
    assert df.count() == 0 and "signup_date" in df.columns
    assert read_raw_csv(spark, p + ".missing", TABLES["users"].bronze_schema(), on_missing="skip") is None
    with pytest.raises(MissingSourceError):
        read_raw_csv(spark, p + ".missing", TABLES["users"].bronze_schema(), on_missing="fail")


def test_normalise_nulls_exact_match(spark):
    df = spark.createDataFrame([("NA",), (" NA",), ("x",)], "c string")
    assert [r[0] for r in normalise_nulls(df).collect()] == [None, " NA", "x"]


def test_enforce_fails_on_violation(spark):
    df = spark.createDataFrame([("1", 5), ("1", -1)], "user_id string, age int")
    checks = [c for c in TABLES["users"].checks if c.column in ("user_id", "age")]
    with pytest.raises(ExpectationError):
        enforce(df, "users", checks)
    enforce(df.where(F.col("age") > 0), "users", checks)


FEEDBACK = TABLES["feedback"].bronze_schema()


def test_columns_are_found_by_header_name(spark):
    p = _write("name,extra,user_id,gender,age,signup_date,city\nAnn,x,u1,f,30,2023-01-01,Rome\n")
    row = read_raw_csv(spark, p, TABLES["users"].bronze_schema()).collect()[0]
    assert (row["user_id"], row["name"], row["city"]) == ("u1", "Ann", "Rome")


def test_missing_column_fails(spark):
    with pytest.raises(ValueError):
        read_raw_csv(spark, _write("user_id,name\nu1,Ann\n"), TABLES["users"].bronze_schema())


def test_doubled_quotes_and_line_breaks_in_cells(spark):
    head = ",".join(f.name for f in FEEDBACK.fields)
    cells = {f.name: "1" for f in FEEDBACK.fields}
    cells["comments"] = '"said ""hi, there"" ok\nline two"'
    p = _write(head + "\n" + ",".join(cells.values()) + "\n")
    rows = read_raw_csv(spark, p, FEEDBACK, multi_line=True).collect()
    assert [r["comments"] for r in rows] == ['said "hi, there" ok\nline two']


def test_missing_payments_stop_the_pipeline(spark):
    from kiln.plans.pipeline import PipelineConfig, run
    d = tempfile.mkdtemp(prefix="kiln-raw-")
    for name in ("users", "captains", "rides", "feedback"):
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write(",".join(c.name for c in TABLES[name].bronze_schema().fields) + "\n")
    with pytest.raises(MissingSourceError):
        run(spark, PipelineConfig(root=tempfile.mkdtemp(prefix="kiln-out-"), raw_dir=d))


# ------------------------------------------------------------------ lines, headers
USERS = TABLES["users"].bronze_schema()
HEAD = "user_id,name,gender,age,signup_date,city\n"


def _folder(*texts):
    d = tempfile.mkdtemp(prefix="kiln-csv-")
    for i, t in enumerate(texts):
        with open(os.path.join(d, f"{i}.csv"), "wb") as f:
            f.write(t if isinstance(t, bytes) else t.encode())
    return d


def test_surplus_and_short_lines_are_audited(spark):
    p = _write(HEAD + "u1,Ann,f,30,2023-01-01,Rome,EXTRA\nu2,Bob\nu3,Cid,m,1,2023-01-01,Rome\n"
                      'u4,"a,b",m,1,2023-01-01,"c""d,e",f\n\nu5,,,,,\n')
    lines = read_lines(spark, p, USERS).cache()
    rows = {r.user_id: r.name for r in loaded(lines).collect()}
    assert rows == {"u2": "Bob", "u3": "Cid", "u5": None}
    audit = {(r.raw_line, r.problem, r.loaded) for r in line_audit(lines).collect()}
    assert audit == {("u1,Ann,f,30,2023-01-01,Rome,EXTRA", SURPLUS, False), ("u2,Bob", SHORT, True),
                     ('u4,"a,b",m,1,2023-01-01,"c""d,e",f', SURPLUS, False)}
    assert line_audit(lines).first().file.endswith("t.csv")


def test_every_file_of_a_folder_has_its_own_header(spark):
    d = _folder(HEAD + "u1,Ann,f,30,2023-01-01,Rome\n", "name,user_id,city,age,gender,signup_date\nBob,u2,Oslo,4,m,x\n",
                "\ufeff" + HEAD.replace("user_id", '"user_id"') + "u3,Cid,m,1,2023-01-01,Rome\n", "", HEAD,
                "extra," + HEAD.strip() + ",name\nx,u4,Dan,m,1,2023-01-01,Rome,second name\n")
    rows = {r.user_id: (r.name, r.city) for r in read_raw_csv(spark, d, USERS).collect()}
    assert rows == {"u1": ("Ann", "Rome"), "u2": ("Bob", "Oslo"), "u3": ("Cid", "Rome"), "u4": ("Dan", "Rome")}
    with pytest.raises(ValueError, match="signup_date"):
        read_raw_csv(spark, _folder(HEAD, HEAD.replace("signup_date", "date") + "1,2,3,4,5,6\n"), USERS)


def test_compressed_files_and_landing_order(spark):
    import gzip
    d = _folder(HEAD + "".join(f"u{i},n,m,1,2023-01-01,x\n" for i in range(50)))
    with gzip.open(os.path.join(d, "1.csv.gz"), "wt") as f:
        f.write("city," + HEAD.strip().removesuffix(",city") + "\n" + "".join(f"x,u{i},n,m,1,2023-01-01\n" for i in range(50, 90)))
    rows = read_raw_csv(spark, d, USERS).orderBy("_seq").collect()
    assert [r.user_id for r in rows] == [f"u{i}" for i in range(90)] and {r.city for r in rows} == {"x"}


def test_empty_and_missing_folders(spark):
    assert read_raw_csv(spark, _folder(), USERS).count() == 0
    assert read_raw_csv(spark, _folder("", HEAD), USERS).columns == [f.name for f in USERS.fields] + ["_seq"]
    assert read_raw_csv(spark, _folder() + "/none", USERS, on_missing="skip") is None
    with pytest.raises(MissingSourceError):
        read_raw_csv(spark, [_folder(HEAD), "/tmp/kiln-no-such-folder"], USERS)
