"""Silver-vs-gold reconciliation: the same totals computed from both layers, compared
metric by metric with a tolerance.

Each side is reduced to a handful of one-row aggregates (partial + final aggregation),
unpivoted to (metric, value) rows and unioned; the two sides meet in a join on the
metric name. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Context, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators.aggregates import mode_by
from kiln.plans.gold import ACTIVE_STATUSES, recent_cutoff, ride_payment_totals

TOLERANCE = 0.01
# Report metric names, in report order.
USER_METRICS = ["total_rides", "total_revenue", "avg_revenue_per_ride", "booking_frequency",
                "is_active", "avg_captain_rating", "most_frequent_issue"]
CAPTAIN_METRICS = ["total_captains", "total_rides_sum", "completed_rides_sum",
                   "cancelled_rides_sum", "total_distance_km_sum", "total_duration_min_sum",
                   "total_final_amount_sum", "avg_user_rating_avg"]


#: Metric values: sums of money stay exact far beyond a double's cents.
VALUE = "decimal(38,12)"


def _text(name: str, value_df: DataFrame, col: str) -> DataFrame:
    # value_df has at most one row; an empty frame still yields the metric with null.
    return value_df.agg(F.max(col).alias("text")).select(
        F.lit(name).alias("metric"), F.lit(None).cast(VALUE).alias("value"), F.col("text"))


def _unpivot(one_row: DataFrame, names: list[str], text: Column | None = None,
             metric: str | None = None) -> DataFrame:
    if metric:
        return one_row.select(F.lit(metric).alias("metric"), F.lit(None).cast(VALUE).alias("value"),
                              text.alias("text"))
    stack = ", ".join(f"'{n}', TRY_CAST(`{n}` AS {VALUE})" for n in names)
    return one_row.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)") \
        .withColumn("text", F.lit(None).cast("string"))


def user_metrics_silver(rides: DataFrame, payments: DataFrame, feedback: DataFrame,
                        as_of: date | str | None = None) -> DataFrame:
    """One aggregate for each source, and the count of issues; payments and feedback count as
    far as their ride is in ``rides``."""
    active = F.when(F.col("ride_status").isin(ACTIVE_STATUSES), F.col("user_id"))
    of_rides = rides.agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if(F.col("ride_date") >= recent_cutoff(as_of)).alias("booking_frequency"),
        F.count_distinct(active).alias("is_active"))
    nz = lambda c: F.nullif(F.col(c), F.lit(0)).cast("double")
    paid = payments.join(rides.select("ride_id"), "ride_id", "left_semi").agg(
        F.coalesce(F.sum("final_amount"), F.lit(0)).alias("total_revenue"),
        F.avg(nz("final_amount")).alias("avg_revenue_per_ride"))
    # counts per rating and issue feed both feedback metrics
    rated = feedback.join(rides.select("ride_id"), "ride_id", "left_semi").groupBy("issue_category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(nz("captain_rating")).alias("s"), F.count(nz("captain_rating")).alias("k"))
    known = F.col("issue_category").isNotNull()
    of_feedback = rated.agg(
        F.try_divide(F.sum("s"), F.sum("k").cast("double")).alias("avg_captain_rating"),
        F.min(F.when(known, F.struct((-F.col("n")).alias("n"), F.col("issue_category").alias("v"))))["v"].alias("issue"))
    rating = _unpivot(of_feedback, ["avg_captain_rating"])
    issue = _unpivot(of_feedback, ["issue"], F.col("issue"), "most_frequent_issue")
    return reduce(DataFrame.unionByName, [
        _unpivot(of_rides, ["total_rides", "booking_frequency", "is_active"]),
        _unpivot(paid, ["total_revenue", "avg_revenue_per_ride"]), rating, issue])


def user_metrics_gold(user_agg: DataFrame) -> DataFrame:
    one = user_agg.agg(
        F.sum("total_rides").alias("total_rides"),
        F.sum("total_revenue").alias("total_revenue"),
        F.try_divide(F.sum(F.col("avg_revenue_per_ride") * F.col("total_rides")),
                     F.nullif(F.sum("total_rides"), F.lit(0))).alias("avg_revenue_per_ride"),
        F.sum("booking_frequency").alias("booking_frequency"),
        F.sum("is_active").alias("is_active"),
        F.avg(F.col("avg_captain_rating").cast("double")).alias("avg_captain_rating"))
    nums = _unpivot(one, USER_METRICS[:-1])
    txt = _text("most_frequent_issue", mode_by(user_agg, [], "most_frequent_issue", "m"), "m")
    return nums.unionByName(txt)


def captain_metrics_silver(captains: DataFrame, rides: DataFrame, payments: DataFrame,
                           feedback: DataFrame) -> DataFrame:
    per_ride = (rides.select("ride_id", "captain_id", "ride_status", "distance_km", "duration_min")
                .join(ride_payment_totals(payments), "ride_id", "left")
                .join(feedback.groupBy("ride_id").agg(
                    F.sum(F.col("user_rating").cast("double")).alias("ur_sum"),
                    F.count("user_rating").alias("ur_n")), "ride_id", "left"))
    per_captain = per_ride.groupBy("captain_id").agg(
        F.count("ride_id").alias("total_rides"),
        F.count_if(F.col("ride_status") == "completed").alias("completed_rides"),
        F.count_if(F.col("ride_status") == "cancelled").alias("cancelled_rides"),
        F.sum(F.coalesce(F.col("distance_km"), F.lit(0))).alias("total_distance_km"),
        F.sum(F.coalesce(F.col("duration_min"), F.lit(0))).alias("total_duration_min"),
        F.sum(F.coalesce(F.col("total_payment"), F.lit(0))).alias("total_final_amount"),
        F.try_divide(F.sum("ur_sum"), F.nullif(F.sum("ur_n"), F.lit(0)).cast("double")).alias("avg_user_rating"))
    c = captains.select("captain_id").join(per_captain, "captain_id", "left")
    one = c.agg(
        F.count_distinct("captain_id").alias("total_captains"),
        F.coalesce(F.sum("total_rides"), F.lit(0)).alias("total_rides_sum"),
        F.coalesce(F.sum("completed_rides"), F.lit(0)).alias("completed_rides_sum"),
        F.coalesce(F.sum("cancelled_rides"), F.lit(0)).alias("cancelled_rides_sum"),
        F.coalesce(F.sum("total_distance_km"), F.lit(0)).alias("total_distance_km_sum"),
        F.coalesce(F.sum("total_duration_min"), F.lit(0)).alias("total_duration_min_sum"),
        F.coalesce(F.sum("total_final_amount"), F.lit(0)).alias("total_final_amount_sum"),
        F.coalesce(F.avg("avg_user_rating"), F.lit(0.0)).alias("avg_user_rating_avg"))
    return _unpivot(one, CAPTAIN_METRICS)


def captain_metrics_gold(captain_agg: DataFrame) -> DataFrame:
    one = captain_agg.agg(
        F.count_distinct("captain_id").alias("total_captains"),
        F.coalesce(F.sum("total_rides"), F.lit(0)).alias("total_rides_sum"),
        F.coalesce(F.sum("completed_rides"), F.lit(0)).alias("completed_rides_sum"),
        F.coalesce(F.sum("cancelled_rides"), F.lit(0)).alias("cancelled_rides_sum"),
        F.coalesce(F.sum("total_distance_km"), F.lit(0)).alias("total_distance_km_sum"),
        F.coalesce(F.sum("total_duration_min"), F.lit(0)).alias("total_duration_min_sum"),
        F.coalesce(F.sum("total_final_amount"), F.lit(0)).alias("total_final_amount_sum"),
        F.coalesce(F.avg(F.col("avg_user_rating").cast("double")), F.lit(0.0)).alias("avg_user_rating_avg"))
    return _unpivot(one, CAPTAIN_METRICS)


def compare(silver: DataFrame, gold: DataFrame, entity: str | None = None,
            tolerance: float = TOLERANCE) -> DataFrame:
    """Metric-by-metric verdict.

    Numbers: difference = silver - gold in decimals, OK iff |difference| < tolerance.
    Anything else: no difference, OK iff equal (two nulls are equal).
    """
    s = silver.select("metric", F.col("value").alias("silver_value"), F.col("text").alias("silver_text"))
    g = gold.select("metric", F.col("value").alias("gold_value"), F.col("text").alias("gold_text"))
    j = s.join(g, "metric", "full")
    numeric = F.col("silver_value").isNotNull() & F.col("gold_value").isNotNull()
    diff = F.when(numeric, F.col("silver_value") - F.col("gold_value"))
    equal = (F.col("silver_value").eqNullSafe(F.col("gold_value"))
             & F.col("silver_text").eqNullSafe(F.col("gold_text")))
    status = F.when(numeric, F.when(F.abs(diff) < F.lit(str(tolerance)).cast(VALUE), "OK").otherwise("MISMATCH")) \
        .otherwise(F.when(equal, "OK").otherwise("MISMATCH"))
    out = j.select("metric", "silver_value", "gold_value", "silver_text", "gold_text",
                   diff.alias("difference"), status.alias("status"))
    if entity is not None:
        out = out.withColumn("entity", F.lit(entity))
    return out


def report(user_report: DataFrame, captain_report: DataFrame) -> DataFrame:
    """Both entity reports in one table (Entity tags each row)."""
    return user_report.unionByName(captain_report)


#: Rows of the report in the order of its metrics, users first.
_ORDER = {("User", m): i for i, m in enumerate(USER_METRICS)} | {
    ("Captain", m): len(USER_METRICS) + i for i, m in enumerate(CAPTAIN_METRICS)}


def report_text(rep: DataFrame) -> DataFrame:
    """Render as the exported CSV layout: Metric, Silver, Gold, Difference, Status, Entity;
    ``_position`` orders the rows."""
    place = F.create_map(*[x for (e, m), i in _ORDER.items() for x in (F.lit(f"{e} {m}"), F.lit(i))])
    plain = lambda c: F.regexp_replace(F.col(c).cast("string"), r"\.?0+$", "")
    return rep.select(
        F.col("metric").alias("Metric"),
        F.coalesce(plain("silver_value"), F.col("silver_text")).alias("Silver"),
        F.coalesce(plain("gold_value"), F.col("gold_text")).alias("Gold"),
        plain("difference").alias("Difference"), F.col("status").alias("Status"),
        F.col("entity").alias("Entity"),
        place[F.concat_ws(" ", "entity", "metric")].alias("_position"))


# ---------------------------------------------------------------- metrics taken while writing
#: Issue categories whose counts a feedback write keeps exactly; beyond it the mode is counted.
ISSUE_CATEGORIES = 5000


def write_metrics(table: str, as_of: date | str | None = None) -> dict[str, Column]:
    """Aggregates that the write of a silver table observes: sums (money in decimals), counts,
    and the counts of the issue categories, all mergeable one-row states."""
    nz = lambda c: F.nullif(F.col(c), F.lit(0))
    status = F.col("ride_status")
    return {
        "users": {},
        "captains": {"total_captains": F.count("captain_id")},
        "rides": {"total_rides": F.count(F.lit(1)),
                  "booking_frequency": F.count_if(F.col("ride_date") >= recent_cutoff(as_of)),
                  "completed": F.count_if(status == "completed"),
                  "cancelled": F.count_if(status == "cancelled"),
                  "distance_km": F.sum(F.col("distance_km").cast("decimal(28,2)")),
                  "duration_min": F.sum("duration_min")},
        "payments": {"revenue": F.sum(F.col("final_amount").cast("decimal(28,2)")),
                     "paid": F.sum(nz("final_amount").cast("decimal(28,2)")),
                     "paid_n": F.count(nz("final_amount"))},
        "feedback": {"rating": F.sum(nz("captain_rating").cast("decimal(28,1)")),
                     "rating_n": F.count(nz("captain_rating")),
                     "issues": F.expr("approx_top_k(issue_category, "
                                      f"{ISSUE_CATEGORIES}, {2 * ISSUE_CATEGORIES})")},
    }[table]


def most_common(issues: list | None, count: Callable[[], str | None]) -> str | None:
    """The mode from observed category counts, ties to the smallest text. The counts are exact
    as long as there are fewer categories than were asked for; else ``count`` is called."""
    if issues and len(issues) >= ISSUE_CATEGORIES:
        return count()
    known = [(-r["count"], r["item"]) for r in issues or [] if r["item"] is not None]
    return min(known)[1] if known else None


def _rows(spark: SparkSession, values: dict[str, object]) -> DataFrame:
    def number(v):
        if v is None or isinstance(v, str):
            return None
        return Decimal(str(v)).quantize(Decimal("1e-12"), context=Context(prec=38))
    return spark.createDataFrame(
        [(m, number(v), v if isinstance(v, str) else None) for m, v in values.items()],
        f"metric string, value {VALUE}, text string")


def _mean(total, n):
    return total / n if total is not None and n else None


def observed_user_metrics(spark: SparkSession, seen: dict[str, dict], active_users: int,
                          issue: str | None) -> DataFrame:
    """The silver side of the user report from what the writes observed."""
    r, p, f = seen["rides"], seen["payments"], seen["feedback"]
    return _rows(spark, {
        "total_rides": r["total_rides"],
        # every silver payment has its ride in silver
        "total_revenue": p["revenue"] or 0,
        "avg_revenue_per_ride": _mean(p["paid"], p["paid_n"]),
        "booking_frequency": r["booking_frequency"], "is_active": active_users,
        "avg_captain_rating": _mean(f["rating"], f["rating_n"]), "most_frequent_issue": issue})


def observed_captain_metrics(spark: SparkSession, seen: dict[str, dict],
                             avg_user_rating: float | None) -> DataFrame:
    """The silver side of the captain report from what the writes observed."""
    r, p = seen["rides"], seen["payments"]
    return _rows(spark, {
        "total_captains": seen["captains"]["total_captains"], "total_rides_sum": r["total_rides"],
        "completed_rides_sum": r["completed"], "cancelled_rides_sum": r["cancelled"],
        "total_distance_km_sum": r["distance_km"] or 0, "total_duration_min_sum": r["duration_min"] or 0,
        "total_final_amount_sum": p["revenue"] or 0, "avg_user_rating_avg": avg_user_rating or 0.0})
