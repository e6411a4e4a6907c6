import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from kiln.operators import aggregates as A


@pytest.mark.parametrize("vals", [
    [], [3.0], [1.0, 2.0], [1.0] * 5 + [2.0] * 5, [5.0, 1.0, 3.0, None],
    [round(random.Random(3).gauss(0, 1), 2) for _ in range(5000)],
])
def test_exact_median_matches_spark(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals] or [(None,)], "x double")
    assert A.exact_median(df, "x") == df.select(F.median("x")).first()[0]


def _columns(n):
    rnd = random.Random(5)
    return {"hot": [7.0] * (n // 3) + [rnd.random() * 10 for _ in range(n - n // 3)],
            "smooth": [rnd.random() for _ in range(n)],
            # the two middle ranks lie on either side of a jump between two values
            "halves": [1.0] * (n // 2) + [2.0] * (n - n // 2),
            "constant": [4.0] * n,
            "heavy tail": [10.0 ** rnd.randint(-300, 300) for _ in range(n)],
            "sparse": [rnd.random() if i % 50 == 0 else None for i in range(n)],
            "none": [None] * n}


@pytest.mark.parametrize("final", [10_000, 50, 1])
def test_many_columns_at_once(spark, monkeypatch, final):
    monkeypatch.setattr(A, "MEDIAN_FINAL_ROWS", final)
    cols = _columns(6000)
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"`{c}` double" for c in cols))
    got = A.exact_medians(df.repartition(4), {c: F.col(f"`{c}`") for c in cols})
    for c, vals in cols.items():
        known = [v for v in vals if v is not None]
        assert got[c] == (median(known) if known else None), c


def test_jobs_do_not_depend_on_the_number_of_columns(spark, monkeypatch):
    monkeypatch.setattr(A, "MEDIAN_FINAL_ROWS", 50)
    rnd = random.Random(1)
    df = spark.createDataFrame([tuple(rnd.random() for _ in range(8)) for _ in range(3000)],
                               ", ".join(f"c{i} double" for i in range(8))).checkpoint()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"median{n}", "")
        A.exact_medians(df, {f"c{i}": F.col(f"c{i}") for i in range(n)})
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"median{n}"))
    one, eight = jobs(1), jobs(8)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert eight <= one + 2      # a column may need one round (two jobs) more than another


def test_sketches_that_are_off_cost_rounds_only(spark, monkeypatch):
    monkeypatch.setattr(A, "MEDIAN_FINAL_ROWS", 20)
    monkeypatch.setattr(A, "MEDIAN_ACCURACY", 30)
    monkeypatch.setattr(A, "MEDIAN_GRID", 20)
    vals = [random.Random(9).random() for _ in range(4001)]
    vals = [v + i for i, v in enumerate(vals)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    assert A.exact_median(df, "x") == median(vals)
