import datetime as dt

from pyspark.sql import functions as F

from kiln.functions.exprs import (
    RIDES_DATE_FORMATS, USERS_DATE_FORMATS, fill_text, is_blank, parse_date, strip_ws, to_number,
)
from tests.conftest import frame


def _col(spark, values, expr):
    df = frame(spark, ["x"], [(v,) for v in values])
    return [r[0] for r in df.orderBy("_seq").select(expr).collect()]


def test_users_dates(spark):
    vals = ["2023-01-05", "5/1/2023", "05.01.2023", "05/13/2023", "31/02/2023", " 2023-01-05", None,
            "2023-1-5", "23-01-05", "2023-01-05 10:00"]
    got = _col(spark, vals, parse_date("x", USERS_DATE_FORMATS))
    d = dt.date
    assert got == [d(2023, 1, 5), d(2023, 1, 5), d(2023, 1, 5), d(2023, 5, 13), None, None, None,
                   d(2023, 1, 5), None, None]


def test_rides_dates_trim_and_month_first_dash(spark):
    got = _col(spark, ["12-31-2023", " 2023-01-05 ", "bad", "31.12.2023"],
               parse_date("x", RIDES_DATE_FORMATS, trim=True))
    assert got == [dt.date(2023, 12, 31), dt.date(2023, 1, 5), None, dt.date(2023, 12, 31)]


def test_to_number_grammar(spark):
    vals = ["12", " 12 ", "1.5", ".5", "1.", "-3e2", "abc", "12d", "nan", "inf", "0x10", "1,000", "", None]
    got = _col(spark, vals, to_number("x"))
    assert got == [12.0, 12.0, 1.5, 0.5, 1.0, -300.0, None, None, None, None, None, None, None, None]


def test_strip_blank_fill(spark):
    df = frame(spark, ["x"], [("\t Pune \n",), ("   ",), ("",), (None,)])
    rows = df.orderBy("_seq").select(strip_ws("x"), is_blank("x"), fill_text("x", "Unknown")).collect()
    assert [r[0] for r in rows] == ["Pune", "", "", None]
    assert [r[1] for r in rows] == [False, True, True, True]
    assert [r[2] for r in rows] == ["\t Pune \n", "   ", "Unknown", "Unknown"]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(2.45,), (2.55,), (0.25,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 1)).collect()] == [2.4, 2.6, 0.2]
