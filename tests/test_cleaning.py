import datetime as dt
from decimal import Decimal

from kiln.plans import entities as E
from kiln.schemas import BRONZE_COLUMNS
from tests.conftest import frame


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_clean_users(spark):
    rows = [
        (None, "a", "M", "20", "2023-01-05", "X"),
        ("1", "b", "F", "21", "5/1/2023", "Y"),
        ("2", "c", "F", "22", "31/02/2023", "Y"),
        ("3", "d", "M", "23", " 2023-01-05", "Z"),
        ("1", "b2", "F", "21", "2023-01-05", "Y"),      # duplicate: silently dropped
        ("4", "e", "M", "24", None, "Z"),
        ("5", "f", "M", "25", "05/13/2023", "Z"),
    ]
    res = E.clean_users(frame(spark, BRONZE_COLUMNS["users"], rows))
    clean = _by(res.clean, "user_id")
    assert set(clean) == {"1", "5"}
    assert clean["1"]["name"] == "b" and clean["1"]["signup_date"] == dt.date(2023, 1, 5)
    assert clean["5"]["signup_date"] == dt.date(2023, 5, 13)
    reasons = sorted((r["user_id"] or "", r["reason"]) for r in res.rejects.collect())
    assert reasons == [("", "null_user_id"), ("2", "invalid_signup_date"), ("3", "invalid_signup_date"),
                       ("4", "invalid_signup_date")]


def test_clean_users_audited_duplicates(spark):
    rows = [("1", "a", "M", "20", "2023-01-05", "X"), ("1", "b", "M", "20", "2023-01-05", "X")]
    res = E.clean_users(frame(spark, BRONZE_COLUMNS["users"], rows), audit_duplicates=True)
    assert [r["reason"] for r in res.rejects.collect()] == ["duplicate_user_id"]


def test_clean_captains(spark):
    cols = BRONZE_COLUMNS["captains"]
    rows = [
        (None, "n0", "30", "1", "A", "4.0"),
        ("1", "  ", "30", "1", None, "2.45"),        # first copy, blank name: wins then rejected
        ("1", "dup", "31", "1", "B", "3.0"),         # duplicate of an alive first copy
        ("2", "x", "abc", "1", " Pune ", None),      # age and rating from medians
        ("3", "y", None, "1", "C", "2.45"),
        ("4", "z", "40", "1", "D", "1.0"),
    ]
    res = E.clean_captains(frame(spark, cols, rows))
    clean = _by(res.clean, "captain_id")
    assert set(clean) == {"2", "3", "4"}
    # survivors before the name rule: ids 1,2,3,4 -> ages 30, null, null, 40 -> median 35
    assert clean["2"]["age"] == 35 and clean["3"]["age"] == 35
    # ratings 2.45, null, 2.45, 1.0 -> median 2.45 -> half-even 2.4
    assert clean["2"]["rating"] == Decimal("2.40") and clean["3"]["rating"] == Decimal("2.40")
    assert clean["2"]["city"] == "Pune" and clean["4"]["city"] == "D"
    reasons = sorted((r["captain_id"] or "", r["name"], r["reason"]) for r in res.rejects.collect())
    assert reasons == [("", "n0", "null_captain_id"), ("1", "  ", "null_or_empty_name"),
                       ("1", "dup", "duplicate_captain_id")]


def _users_captains(spark):
    u = frame(spark, ["user_id"], [("u1",), ("u2",)], seq=False)
    c = frame(spark, ["captain_id"], [("c1",), ("c2",)], seq=False)
    return u, c


def test_clean_rides(spark):
    cols = BRONZE_COLUMNS["rides"]
    rows = [
        (None, "u1", "c1", "2023-01-01", "p", "d", "1", "10", "completed"),
        ("  ", "u1", "c1", "2023-01-01", "p", "d", "1", "10", "completed"),
        ("r1", "", "c1", "2023-01-01", "p", "d", "1", "10", "completed"),
        ("r2", "u1", None, "2023-01-01", "p", "d", "1", "10", "completed"),
        ("r3", "u1", "c1", "bad", "p", "d", "1", "10", "completed"),
        ("r4", "u9", "c1", "12-31-2023", "p", "d", "1", "10", "completed"),
        ("r5", "u1", "c9", "2023-01-01", "p", "d", "1", "10", "completed"),
        ("r6", "u9", "c9", "2023-01-01", "p", "d", "1", "10", "completed"),
        ("r7", "u9", "c1", "2023-01-01", "p", "d", "1", "10", "completed"),   # invalid first copy
        ("r7", "u1", "c1", " 2023-01-05 ", "", None, "abc", None, None),      # valid second copy survives
        ("r8", "u2", "c2", "2023-01-02", "p", "d", "3", "20", "cancelled"),
        ("r8", "u2", "c2", "2023-01-02", "p", "d", "3", "20", "cancelled"),   # duplicate
        ("r9", "u2", "c2", "2023-01-03", "p", "d", "5", "31", "completed"),
        ("r10", "u2", "c2", "2023-01-03", "p", "d", "7", "40", "cancelled"),
    ]
    u, c = _users_captains(spark)
    res = E.clean_rides(frame(spark, cols, rows), u, c)
    clean = _by(res.clean, "ride_id")
    assert set(clean) == {"r7", "r8", "r9", "r10"}
    r7 = clean["r7"]
    assert r7["ride_date"] == dt.date(2023, 1, 5)
    assert r7["pickup_loc"] == "Unknown" and r7["drop_loc"] == "Unknown"
    # distance median over 3,5,7 (+null) = 5; duration median over 20,31,40 = 31
    assert r7["distance_km"] == Decimal("5.00") and r7["duration_min"] == 31
    # tied mode: cancelled x2 vs completed x1 -> cancelled
    assert r7["ride_status"] == "cancelled"
    reasons = sorted((r["ride_id"] or "<null>", r["reason"]) for r in res.rejects.collect())
    assert reasons == sorted([
        ("<null>", "null_or_empty_ride_id"), ("  ", "null_or_empty_ride_id"),
        ("r1", "null_or_empty_user_id"), ("r2", "null_or_empty_captain_id"),
        ("r3", "null_or_invalid_ride_date"), ("r4", "invalid_user_id_not_in_users"),
        ("r5", "invalid_captain_id_not_in_captains"), ("r6", "invalid_user_id_not_in_users"),
        ("r7", "invalid_user_id_not_in_users"), ("r8", "duplicate_ride_id")])


def test_mode_tie_takes_smallest(spark):
    cols = BRONZE_COLUMNS["rides"]
    rows = [("r1", "u1", "c1", "2023-01-01", "p", "d", "1", "1", "ongoing"),
            ("r2", "u1", "c1", "2023-01-01", "p", "d", "1", "1", "completed"),
            ("r3", "u1", "c1", "2023-01-01", "p", "d", "1", "1", None)]
    u, c = _users_captains(spark)
    res = E.clean_rides(frame(spark, cols, rows), u, c)
    assert _by(res.clean, "ride_id")["r3"]["ride_status"] == "completed"


def test_clean_payments(spark):
    cols = BRONZE_COLUMNS["payments"]
    rides = frame(spark, ["ride_id"], [("r1",), ("r2",)], seq=False)
    rows = [
        ("p1", None, "cash", "10", "0", "0", "10", "paid"),
        ("p2", "r9", "cash", "10", "0", "0", "10", "paid"),
        ("p3", "r1", "cash", "abc", None, "12d", "9.5", "paid"),
        ("p4", "r1", "card", "20", "10", "2", "18", "paid"),
        ("p5", "r2", "card", "40", "5", "2", "38", "paid"),
    ]
    res = E.clean_payments(frame(spark, cols, rows), rides)
    clean = _by(res.clean, "payment_id")
    assert set(clean) == {"p3", "p4", "p5"}
    p3 = clean["p3"]
    assert p3["fare"] == Decimal("30.00")          # median of 20, 40
    assert p3["discount_percent"] == Decimal("0.00") and p3["discount_amount"] == Decimal("0.00")
    assert sorted((r["payment_id"], r["reason"]) for r in res.rejects.collect()) == [
        ("p1", "null_or_empty_ride_id"), ("p2", "invalid_ride_id_not_in_rides")]


def test_clean_feedback(spark):
    cols = BRONZE_COLUMNS["feedback"]
    rides = frame(spark, ["ride_id"], [("r1",), ("r2",)], seq=False)
    rows = [
        (None, "r1", "4", "5", "x", "y"),
        ("f1", " ", "4", "5", "x", "y"),
        ("f2", "r9", "4", "5", "x", "y"),
        ("f3", "r1", "bad", None, "", None),
        ("f4", "r1", "2", "4", "late", "ok"),
        ("f5", "r2", "3", "1", "late", "ok"),
    ]
    res = E.clean_feedback(frame(spark, cols, rows), rides)
    clean = _by(res.clean, "feedback_id")
    assert set(clean) == {"f3", "f4", "f5"}
    f3 = clean["f3"]
    assert f3["user_rating"] == Decimal("2.5") and f3["captain_rating"] == Decimal("2.5")
    assert f3["issue_category"] == "No issues" and f3["comments"] == "No comments"
    assert sorted((r["feedback_id"] or "", r["reason"]) for r in res.rejects.collect()) == [
        ("", "null_or_empty_feedback_id"), ("f1", "null_or_empty_ride_id"), ("f2", "ride_id_not_in_rides")]


def test_keep_first_keeps_one_of_equal_copies(spark):
    from pyspark.sql import functions as F

    from kiln.operators.quarantine import REASON, alive, reject_duplicates, start
    rows = [("a", 1, "x")] * 3 + [("a", 0, "y"), ("a", 0, "y"), ("b", 5, "z"), (None, 2, "n"), (None, 2, "n")]
    df = start(spark.createDataFrame(rows, "k string, o long, v string"))
    out = reject_duplicates(df, "k", "dup", order="o")
    assert sorted(map(str, (r["v"] for r in alive(out).collect()))) == ["n", "y", "z"]
    assert out.where(F.col(REASON) == "dup").count() == 5
