"""Gold data products: per-user and per-captain aggregates and the dashboard table.

Payments and feedback are first reduced to ride grain (one partially aggregated
shuffle each), joined to rides on ride_id, and rolled up per user or captain. A user's
or captain's rides never have to meet in one task: every aggregate, the modes included,
combines map-side.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.aggregates import mode_by, modes_by
from kiln.operators.factorised import Factorised, factorise
from kiln.operators.joins import full_join_lookup, left_join_many
from kiln.session import parquet_stage

Observe = Callable[[DataFrame], DataFrame]

# Ride status vocabulary used by the gold rules.
COMPLETED, CANCELLED = "completed", "cancelled"
ACTIVE_STATUSES = [COMPLETED, CANCELLED]
RECENT_DAYS = 30


def _lit_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")


def recent_cutoff(as_of: date | str | None) -> Column:
    """``as_of - INTERVAL 30 DAYS`` (inclusive lower bound, no upper bound)."""
    return F.date_sub(_lit_date(as_of), RECENT_DAYS)


def ride_payment_totals(payments: DataFrame) -> DataFrame:
    """Per ride: SUM(COALESCE(final_amount, 0))."""
    return payments.groupBy("ride_id").agg(
        F.sum(F.coalesce(F.col("final_amount"), F.lit(0))).alias("total_payment"))


def _nonzero(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(0)).cast("double")


def ride_feedback_stats(feedback: DataFrame) -> DataFrame:
    """Per ride: sums and counts of non-zero ratings and of all user ratings."""
    return feedback.groupBy("ride_id").agg(
        F.sum(_nonzero("captain_rating")).alias("cr_sum"),
        F.count(_nonzero("captain_rating")).alias("cr_n"),
        F.sum(_nonzero("user_rating")).alias("ur_sum"),
        F.count(_nonzero("user_rating")).alias("ur_n"),
        F.sum(F.col("user_rating").cast("double")).alias("ur_all_sum"),
        F.count(F.col("user_rating")).alias("ur_all_n"))


def _ratio(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den))


def user_aggregate(users: DataFrame, rides: DataFrame, payments: DataFrame,
                   feedback: DataFrame, as_of: date | str | None = None,
                   observe: Observe | None = None) -> DataFrame:
    """One row per silver user (users without rides kept).

    ``observe`` is handed the rides grouped by user (``active``: rides that make a user
    active), before users are attached.

    avg_captain_rating is the mean over the user's rides of each ride's mean non-zero
    captain rating; most_frequent_issue is the mode over rides of each ride's mode.
    """
    fb = ride_feedback_stats(feedback)
    issue = mode_by(feedback, ["ride_id"], "issue_category", "ride_issue")
    per_ride = (rides.select("ride_id", "user_id", "ride_date", "ride_status")
                .join(ride_payment_totals(payments), "ride_id", "left")
                .join(fb.select("ride_id", _ratio("cr_sum", "cr_n").alias("ride_cr")), "ride_id", "left")
                .join(issue, "ride_id", "left")
                .withColumn("total_payment", F.coalesce(F.col("total_payment"), F.lit(0))))
    cutoff = recent_cutoff(as_of)
    # Level 1 groups by (user, ride-level issue) so the mode needs no separate pass.
    lvl1 = per_ride.groupBy("user_id", "ride_issue").agg(
        F.count("ride_id").alias("n"),
        F.min("ride_date").alias("first_ride_date"),
        F.max("ride_date").alias("last_ride_date"),
        F.sum("total_payment").alias("rev"),
        F.count_if(F.col("ride_date") >= cutoff).alias("recent"),
        F.count_if(F.col("ride_status").isin(ACTIVE_STATUSES)).alias("active"),
        F.sum("ride_cr").alias("cr_sum"), F.count("ride_cr").alias("cr_n"))
    best_issue = F.min(F.when(F.col("ride_issue").isNotNull(),
                              F.struct((-F.col("n")).alias("neg_n"), F.col("ride_issue").alias("v"))))
    per_user = lvl1.groupBy("user_id").agg(
        F.sum("n").alias("total_rides"),
        F.min("first_ride_date").alias("first_ride_date"),
        F.max("last_ride_date").alias("last_ride_date"),
        F.sum("rev").alias("rev"),
        F.sum("recent").alias("booking_frequency"),
        F.sum("active").alias("active"),
        F.sum("cr_sum").alias("cr_sum"), F.sum("cr_n").alias("cr_n"),
        best_issue["v"].alias("most_frequent_issue"))
    if observe:
        per_user = observe(per_user)
    out = users.select("user_id", "name", "age", "gender", "city", "signup_date") \
        .join(per_user, "user_id", "left")
    n = F.coalesce(F.col("total_rides"), F.lit(0)).cast("bigint")
    return out.select(
        "user_id", "name", "age", "gender", "city", "signup_date",
        "first_ride_date", "last_ride_date",
        n.alias("total_rides"),
        F.coalesce(F.col("rev"), F.lit(0)).alias("total_revenue"),
        F.when(n > 0, F.col("rev").cast("double") / n).alias("avg_revenue_per_ride"),
        F.coalesce(F.col("booking_frequency"), F.lit(0)).cast("bigint").alias("booking_frequency"),
        F.when(F.coalesce(F.col("active"), F.lit(0)) > 0, 1).otherwise(0).alias("is_active"),
        _ratio("cr_sum", "cr_n").alias("avg_captain_rating"),
        "most_frequent_issue")


def captain_aggregate(captains: DataFrame, rides: DataFrame, payments: DataFrame,
                      feedback: DataFrame, observe: Observe | None = None) -> DataFrame:
    """One row per silver captain; rating averages are over feedback rows, zeros ignored.

    ``observe`` is handed the rides grouped by captain (``ur_all_sum``, ``ur_all_n``: user
    ratings with zeros), before captains are attached."""
    fb = ride_feedback_stats(feedback)
    per_ride = (rides.select("ride_id", "captain_id", "ride_status", "distance_km", "duration_min")
                .join(ride_payment_totals(payments), "ride_id", "left")
                .join(fb, "ride_id", "left"))
    per_captain = per_ride.groupBy("captain_id").agg(
        F.count("ride_id").alias("total_rides"),
        F.count_if(F.col("ride_status") == COMPLETED).alias("completed_rides"),
        F.count_if(F.col("ride_status") == CANCELLED).alias("cancelled_rides"),
        F.sum("distance_km").alias("total_distance_km"),
        F.sum("duration_min").alias("total_duration_min"),
        F.sum(F.coalesce(F.col("total_payment"), F.lit(0))).alias("total_final_amount"),
        F.sum("cr_sum").alias("cr_sum"), F.sum("cr_n").alias("cr_n"),
        F.sum("ur_sum").alias("ur_sum"), F.sum("ur_n").alias("ur_n"),
        F.sum("ur_all_sum").alias("ur_all_sum"), F.sum("ur_all_n").alias("ur_all_n"),
        F.count_if(F.col("ride_status").isin(ACTIVE_STATUSES)).alias("active"))
    if observe:
        per_captain = observe(per_captain)
    fr = feedback.select("ride_id", "issue_category", "comments") \
        .join(rides.select("ride_id", "captain_id"), "ride_id")
    words = modes_by(fr, "captain_id", {"issue_category": "most_frequent_issue",
                                        "comments": "most_frequent_comment"})
    out = (captains.select("captain_id", "name", "age", "city", "rating")
           .join(per_captain, "captain_id", "left")
           .join(words, "captain_id", "left"))
    z = F.lit(0)
    return out.select(
        "captain_id", "name", "age", "city", F.col("rating").alias("average_rating"),
        F.coalesce(F.col("total_rides"), z).cast("bigint").alias("total_rides"),
        F.coalesce(F.col("completed_rides"), z).cast("bigint").alias("completed_rides"),
        F.coalesce(F.col("cancelled_rides"), z).cast("bigint").alias("cancelled_rides"),
        F.coalesce(F.col("total_distance_km"), z).alias("total_distance_km"),
        F.coalesce(F.col("total_duration_min"), z).cast("bigint").alias("total_duration_min"),
        F.coalesce(F.col("total_final_amount"), z).alias("total_final_amount"),
        _ratio("cr_sum", "cr_n").alias("avg_captain_rating"),
        _ratio("ur_sum", "ur_n").alias("avg_user_rating"),
        F.when(F.coalesce(F.col("active"), z) > 0, F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
        "most_frequent_issue", "most_frequent_comment")


# Dashboard column order.
DASHBOARD_COLUMNS = [
    "user_id", "user_name", "gender", "user_age", "signup_date", "user_city",
    "ride_id", "captain_id", "ride_date", "pickup_loc", "drop_loc", "distance_km",
    "duration_min", "ride_status",
    "payment_id", "payment_method", "fare", "discount_percent", "discount_amount",
    "final_amount", "payment_status",
    "feedback_id", "user_rating", "feedback_captain_rating", "issue_category", "comments",
    "captain_name", "captain_age", "captain_city", "captain_overall_rating",
]


def _details(users: DataFrame, rides: DataFrame, payments: DataFrame, feedback: DataFrame,
             users_first: bool = False) -> DataFrame:
    """Users with their rides, payments and feedback, under the dashboard's names.

    ``users_first`` attaches users to the rides before these meet payments and feedback: what is
    shuffled by the user is a ride, not each of its detail rows with all their columns. Tables that
    lie in buckets of the ride are better joined on it first, which needs no shuffle."""
    u = users.select("user_id", F.col("name").alias("user_name"), "gender",
                     F.col("age").alias("user_age"), "signup_date", F.col("city").alias("user_city"))
    r = rides.select("ride_id", "user_id", "captain_id", "ride_date", "pickup_loc", "drop_loc",
                     "distance_km", "duration_min", "ride_status")
    p = payments.select("ride_id", "payment_id", "payment_method", "fare", "discount_percent",
                        "discount_amount", "final_amount", "payment_status")
    f = feedback.select("ride_id", "feedback_id", "user_rating",
                        F.col("captain_rating").alias("feedback_captain_rating"),
                        "issue_category", "comments")
    # A ride has few payments and feedback rows, none of them a hot key: plain joins on the
    # ride, one scan of each side. A user may have a third of all rides.
    if not users_first:
        return left_join_many(u, r.join(p, "ride_id", "left").join(f, "ride_id", "left"), "user_id", keys=rides)
    ridden = r.join(u, "user_id").join(p, "ride_id", "left").join(f, "ride_id", "left")
    ridden = ridden.select(*u.columns, *[c for c in ridden.columns if c not in u.columns])
    alone = u.join(r.where(F.col("user_id").isNotNull()).select("user_id").distinct(), "user_id", "left_anti")
    return ridden.unionByName(alone, allowMissingColumns=True)


def _captain_profiles(captains: DataFrame) -> DataFrame:
    return captains.select(F.col("captain_id").alias("_cap_id"), F.col("name").alias("captain_name"),
                           F.col("age").alias("captain_age"), F.col("city").alias("captain_city"),
                           F.col("rating").alias("captain_overall_rating"))


def dashboard(users: DataFrame, rides: DataFrame, payments: DataFrame, feedback: DataFrame,
              captains: DataFrame, sort: bool = True, stage=parquet_stage,
              users_first: bool = False) -> DataFrame:
    """One row per user x ride x (payment, feedback) detail, with the ride's captain
    attached; users without rides and captains without rides appear with nulls on the
    other side.

    The captain profile is looked up once per row (captains are unique on their id), so
    the table does not multiply each ride by every ride of the same captain, and a
    ride-less captain keeps its id in ``captain_id``. A ride's payments and feedback rows
    are joined on the ride, for every ride alike: max(payments, 1) * max(feedback, 1) rows.
    """
    # The captain lookup reads the detail rows twice (join, and the ids in use): stage them.
    rwf = stage(_details(users, rides, payments, feedback, users_first))
    c = _captain_profiles(captains)
    full = full_join_lookup(rwf, c, "captain_id", "_cap_id")
    full = full.withColumn("captain_id", F.coalesce(F.col("captain_id"), F.col("_cap_id")))
    if sort:
        # Trailing keys only break ties, so a user with many rows still spans partitions.
        full = full.orderBy(F.col("user_id").asc_nulls_last(), F.col("_cap_id").asc_nulls_last(),
                            F.col("ride_id").asc_nulls_last(), F.col("payment_id").asc_nulls_last(),
                            F.col("feedback_id").asc_nulls_last())
    return full.select(*DASHBOARD_COLUMNS)


def dashboard_fanout_size(users: DataFrame, rides: DataFrame, payments: DataFrame,
                          feedback: DataFrame, captains: DataFrame) -> DataFrame:
    """Size of a dashboard that joins each ride row to *every* ride of its captain,
    per captain, computed from counts alone (the pairs are never produced).

    left_rows: dashboard rows carrying the captain (before the captain side);
    captain_rows: rows of captains LEFT JOIN rides for that captain (at least 1);
    fanout_rows: rows the multiplying join would emit for it.
    """
    per_ride_pay = payments.groupBy("ride_id").agg(F.count(F.lit(1)).alias("np"))
    per_ride_fb = feedback.groupBy("ride_id").agg(F.count(F.lit(1)).alias("nf"))
    # Rides whose user exists reach the left side (left join from users).
    rr = rides.join(users.select("user_id"), "user_id", "left_semi")
    left = (rr.select("ride_id", "captain_id")
            .join(per_ride_pay, "ride_id", "left").join(per_ride_fb, "ride_id", "left")
            .select("captain_id", (F.coalesce("np", F.lit(1)) * F.coalesce("nf", F.lit(1))).alias("rows"))
            .groupBy("captain_id").agg(F.sum("rows").alias("left_rows")))
    cap_rides = rides.groupBy("captain_id").agg(F.count(F.lit(1)).alias("nr"))
    right = captains.select("captain_id").join(cap_rides, "captain_id", "left") \
        .select("captain_id", F.greatest(F.coalesce("nr", F.lit(0)), F.lit(1)).alias("captain_rows"))
    out = right.join(left, "captain_id", "left")
    return out.select("captain_id", F.coalesce("left_rows", F.lit(0)).cast("bigint").alias("left_rows"),
                      F.col("captain_rows").cast("bigint").alias("captain_rows"),
                      F.when(F.col("left_rows") > 0, F.col("left_rows") * F.col("captain_rows"))
                      .otherwise(F.col("captain_rows")).cast("bigint").alias("fanout_rows"))


def dashboard_fanout(users: DataFrame, rides: DataFrame, payments: DataFrame, feedback: DataFrame,
                     captains: DataFrame, stage=parquet_stage, users_first: bool = False) -> Factorised:
    """The dashboard that joins every row to *every* ride of its captain, for reading by pages:
    ``page(start, stop)`` gives its rows of these ranks, ordered by user, captain, ride, payment
    and feedback (nulls last) and the captain's rides; nothing else of the product is made.

    Captains without any row of a user follow at the end, once for each of their rides."""
    details = stage(_details(users, rides, payments, feedback, users_first).withColumn("_cap_id", F.col("captain_id")))
    used = details.where(F.col("_cap_id").isNotNull()).select("_cap_id").distinct()
    unused = captains.select(F.col("captain_id").alias("_cap_id")).join(used, "_cap_id", "left_anti")
    left = details.unionByName(unused, allowMissingColumns=True)
    theirs = rides.select(F.col("captain_id").alias("_cap_id"), F.col("ride_id").alias("captain_ride_id"))
    right = left_join_many(_captain_profiles(captains), theirs, "_cap_id")
    last = lambda *cs: [F.col(c).asc_nulls_last() for c in cs]
    # further columns tell apart rows that share all ids
    return factorise(left, right, "_cap_id", last(
        "user_id", "_cap_id", "ride_id", "payment_id", "feedback_id", "fare", "discount_percent",
        "discount_amount", "final_amount", "payment_method", "payment_status"),
        last("_cap_id", "captain_ride_id"), stage)
