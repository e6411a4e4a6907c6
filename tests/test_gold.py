import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from kiln.plans import gold as G
from kiln.plans import reconcile as R


def _silver(spark):
    users = spark.createDataFrame(
        [("u1", "Ann", 30, "F", "X", dt.date(2020, 1, 1)), ("u2", "Bob", 40, "M", "Y", dt.date(2020, 1, 1)),
         ("u3", "Cy", 50, "M", "Z", dt.date(2020, 1, 1))],
        "user_id string, name string, age int, gender string, city string, signup_date date")
    captains = spark.createDataFrame(
        [("c1", "Cap1", 30, "X", Decimal("4.50")), ("c2", "Cap2", 35, "Y", Decimal("3.00")),
         ("c3", "Cap3", 40, "Z", Decimal("1.00"))],
        "captain_id string, name string, age int, city string, rating decimal(3,2)")
    rides = spark.createDataFrame(
        [("r1", "u1", "c1", dt.date(2023, 1, 2), "a", "b", Decimal("1.50"), 10, "completed"),   # 30 days before as_of
         ("r2", "u1", "c1", dt.date(2022, 6, 1), "a", "b", Decimal("2.00"), 20, "ongoing"),
         ("r3", "u2", "c2", dt.date(2023, 2, 1), "a", "b", Decimal("3.00"), 30, "cancelled")],
        "ride_id string, user_id string, captain_id string, ride_date date, pickup_loc string, "
        "drop_loc string, distance_km decimal(7,2), duration_min int, ride_status string")
    payments = spark.createDataFrame(   # r1: 2 payments, r2: 1, r3: 0
        [("p1", "r1", "cash", Decimal("10.00"), Decimal("0"), Decimal("0"), Decimal("10.00"), "paid"),
         ("p2", "r1", "cash", Decimal("5.00"), Decimal("0"), Decimal("0"), Decimal("5.00"), "paid"),
         ("p3", "r2", "card", Decimal("7.00"), Decimal("0"), Decimal("0"), Decimal("7.00"), "paid")],
        "payment_id string, ride_id string, payment_method string, fare decimal(10,2), "
        "discount_percent decimal(5,2), discount_amount decimal(10,2), final_amount decimal(10,2), payment_status string")
    feedback = spark.createDataFrame(   # rating 0 ignored; tied issues -> smallest
        [("f1", "r1", Decimal("4.0"), Decimal("0.0"), "late", "ok"),
         ("f2", "r1", Decimal("2.0"), Decimal("4.0"), "dirty", "bad"),
         ("f3", "r2", Decimal("0.0"), Decimal("2.0"), "late", "ok")],
        "feedback_id string, ride_id string, user_rating decimal(2,1), captain_rating decimal(2,1), "
        "issue_category string, comments string")
    return users, captains, rides, payments, feedback


def test_user_aggregate(spark):
    u, c, r, p, f = _silver(spark)
    out = {x["user_id"]: x for x in G.user_aggregate(u, r, p, f, "2023-02-01").collect()}
    a = out["u1"]
    assert a["total_rides"] == 2 and a["total_revenue"] == Decimal("22.00")
    assert abs(a["avg_revenue_per_ride"] - 11.0) < 1e-9
    assert a["booking_frequency"] == 1          # 2023-01-02 is exactly as_of - 30 days
    assert a["is_active"] == 1
    assert abs(a["avg_captain_rating"] - 3.0) < 1e-9   # mean of per-ride means 4.0 and 2.0
    assert a["most_frequent_issue"] == "dirty"  # per-ride modes: r1 tie -> dirty, r2 late -> tie -> dirty
    assert a["first_ride_date"] == dt.date(2022, 6, 1) and a["last_ride_date"] == dt.date(2023, 1, 2)
    z = out["u3"]                                # no rides
    assert z["total_rides"] == 0 and z["total_revenue"] == 0 and z["avg_revenue_per_ride"] is None
    assert z["is_active"] == 0 and z["most_frequent_issue"] is None and z["first_ride_date"] is None
    assert out["u2"]["total_revenue"] == 0 and out["u2"]["is_active"] == 1


def test_captain_aggregate(spark):
    u, c, r, p, f = _silver(spark)
    out = {x["captain_id"]: x for x in G.captain_aggregate(c, r, p, f).collect()}
    a = out["c1"]
    assert (a["total_rides"], a["completed_rides"], a["cancelled_rides"]) == (2, 1, 0)
    assert a["total_distance_km"] == Decimal("3.50") and a["total_duration_min"] == 30
    assert a["total_final_amount"] == Decimal("22.00")
    assert abs(a["avg_captain_rating"] - 3.0) < 1e-9    # feedback rows 4.0, 2.0 (0 ignored)
    assert abs(a["avg_user_rating"] - 3.0) < 1e-9       # 4.0, 2.0 (0 ignored)
    assert a["status"] == "active" and a["most_frequent_issue"] == "late" and a["most_frequent_comment"] == "ok"
    n = out["c3"]                                        # captain with no rides
    assert n["total_rides"] == 0 and n["total_final_amount"] == 0 and n["status"] == "inactive"
    assert n["avg_user_rating"] is None and n["average_rating"] == Decimal("1.00")


def test_dashboard_grain(spark):
    u, c, r, p, f = _silver(spark)
    rows = G.dashboard(u, r, p, f, c).collect()
    assert len(rows[0]) == 30
    # r1: 2 payments x 2 feedback rows = 4, r2: 1 x 1, r3: 1 (no payment/feedback), u3: 1, c3: 1
    assert len(rows) == 8
    r1 = [x for x in rows if x["ride_id"] == "r1"]
    assert sorted((x["payment_id"], x["feedback_id"]) for x in r1) == [
        ("p1", "f1"), ("p1", "f2"), ("p2", "f1"), ("p2", "f2")]
    r2 = [x for x in rows if x["ride_id"] == "r2"]
    assert [(x["payment_id"], x["feedback_id"]) for x in r2] == [("p3", "f3")]
    c3 = [x for x in rows if x["captain_name"] == "Cap3"][0]
    assert c3["user_id"] is None and c3["captain_id"] == "c3"
    assert rows[-1]["user_id"] is None          # nulls last
    fan = {x["captain_id"]: x for x in G.dashboard_fanout_size(u, r, p, f, c).collect()}
    assert fan["c1"]["left_rows"] == 5 and fan["c1"]["captain_rows"] == 2 and fan["c1"]["fanout_rows"] == 10


def test_dashboard_pairs_three_payments_with_two_feedback_rows(spark):
    u, c, r, p, f = _silver(spark)
    p3 = p.unionByName(p.where("payment_id = 'p1'").withColumn("payment_id", F.lit("p9")))
    rows = [x for x in G.dashboard(u, r, p3, f, c).collect() if x["ride_id"] == "r1"]
    assert sorted((x["payment_id"], x["feedback_id"]) for x in rows) == [
        (a, b) for a in ("p1", "p2", "p9") for b in ("f1", "f2")]
    fan = {x["captain_id"]: x for x in G.dashboard_fanout_size(u, r, p3, f, c).collect()}
    assert fan["c1"]["left_rows"] == 7


def test_dashboard_matches_join_when_one_side_single(spark):
    """With at most one feedback row per ride the rows equal payments LEFT JOIN feedback."""
    u, c, r, p, f = _silver(spark)
    f1 = f.where("feedback_id <> 'f2'")
    rows = G.dashboard(u, r, p, f1, c).collect()
    r1 = sorted((x["payment_id"], x["feedback_id"]) for x in rows if x["ride_id"] == "r1")
    assert r1 == [("p1", "f1"), ("p2", "f1")]
    p1 = p.where("payment_id <> 'p2'")
    rows = G.dashboard(u, r, p1, f, c).collect()
    r1 = sorted((x["payment_id"], x["feedback_id"]) for x in rows if x["ride_id"] == "r1")
    assert r1 == [("p1", "f1"), ("p1", "f2")]


def test_reconciliation(spark):
    u, c, r, p, f = _silver(spark)
    ua = G.user_aggregate(u, r, p, f, "2023-02-01")
    rep = {x["metric"]: x for x in R.compare(R.user_metrics_silver(r, p, f, "2023-02-01"),
                                             R.user_metrics_gold(ua), "User").collect()}
    assert set(rep) == set(R.USER_METRICS)
    assert rep["total_rides"]["status"] == "OK" and rep["total_rides"]["silver_value"] == 3.0
    assert rep["total_revenue"]["silver_value"] == 22.0 and rep["total_revenue"]["status"] == "OK"
    assert rep["most_frequent_issue"]["silver_text"] == "late"
    assert rep["most_frequent_issue"]["status"] == "MISMATCH"   # mode of modes differs (dirty)
    ca = G.captain_aggregate(c, r, p, f)
    crep = R.compare(R.captain_metrics_silver(c, r, p, f), R.captain_metrics_gold(ca), "Captain").collect()
    assert len(crep) == len(R.CAPTAIN_METRICS)
    byname = {x["metric"]: x for x in crep}
    assert byname["total_captains"]["silver_value"] == 3.0
    assert byname["total_rides_sum"]["status"] == "OK"
    # silver averages all user ratings (0 included), gold ignores zeros: a mismatch is possible
    assert byname["avg_user_rating_avg"]["difference"] is not None
