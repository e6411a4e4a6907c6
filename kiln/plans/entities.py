"""The five cleaning jobs (bronze text -> typed silver + audited rejects) and their DAG.

Each job is a fixed order of rule steps over one labelled frame. Statistics used for
imputation are taken from the rows still alive at that point of the chain: the medians of
all columns in one distributed selection, the modes as scalar subqueries; neither is joined
back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.exprs import (
    RIDES_DATE_FORMATS, USERS_DATE_FORMATS, fill_text, is_blank, parse_date, strip_ws,
    to_int_half_even, truncate_int,
)
from kiln.operators.aggregates import medians_of, mode_of
from kiln.operators.conform import number_for, with_cells
from kiln.operators.quarantine import (
    CleanResult, alive, alive_cond, reject_duplicates, reject_if, reject_orphans, split, start,
)
from kiln.schemas import BRONZE_COLUMNS, TABLES
from kiln.session import parquet_stage

# Reject reasons, verbatim.
NULL_USER_ID = "null_user_id"
INVALID_SIGNUP_DATE = "invalid_signup_date"
DUPLICATE_USER_ID = "duplicate_user_id"
NULL_CAPTAIN_ID = "null_captain_id"
DUPLICATE_CAPTAIN_ID = "duplicate_captain_id"
NULL_OR_EMPTY_NAME = "null_or_empty_name"
NULL_OR_EMPTY_RIDE_ID = "null_or_empty_ride_id"
NULL_OR_EMPTY_USER_ID = "null_or_empty_user_id"
NULL_OR_EMPTY_CAPTAIN_ID = "null_or_empty_captain_id"
NULL_OR_INVALID_RIDE_DATE = "null_or_invalid_ride_date"
USER_NOT_IN_USERS = "invalid_user_id_not_in_users"
CAPTAIN_NOT_IN_CAPTAINS = "invalid_captain_id_not_in_captains"
DUPLICATE_RIDE_ID = "duplicate_ride_id"
PAYMENT_RIDE_NOT_IN_RIDES = "invalid_ride_id_not_in_rides"
NULL_OR_EMPTY_FEEDBACK_ID = "null_or_empty_feedback_id"
FEEDBACK_RIDE_NOT_IN_RIDES = "ride_id_not_in_rides"

Stage = Callable[[DataFrame], DataFrame]


def _raw(bronze: DataFrame, table: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Every row alive, with its cells that cannot be assigned."""
    return with_cells(start(bronze), TABLES[table], skip)


def _typed(df: DataFrame, table: str, numbers: dict[str, str], assigned: dict[str, str]) -> DataFrame:
    """Labelled rows with their numbers, worked out once, before the rows are staged, and after they
    were shuffled."""
    return with_cells(df, TABLES[table], numbers=numbers, assigned=assigned)


def _number(table: str, column: str):
    """The cell's number; text, and numbers that the silver column cannot hold, are missing."""
    return number_for(column, dict(TABLES[table].silver_types)[column])


def _audited_text(df: DataFrame, *columns: str) -> DataFrame:
    """After the last rule: the raw text of typed columns is kept for rejects, whose audit reads it,
    and not written again for the rows that stay."""
    return df.withColumns({c: F.when(~alive_cond(), F.col(c)) for c in columns})


# Constant fills.
UNKNOWN = "Unknown"
NO_ISSUES = "No issues"
NO_COMMENTS = "No comments"


def clean_users(bronze: DataFrame, run_ts: datetime | None = None,
                audit_duplicates: bool = False, stage: Stage = parquet_stage) -> CleanResult:
    """Null id -> parse signup date -> keep first copy per id (silently by default)."""
    df = _raw(bronze, "users")
    df = reject_if(df, F.col("user_id").isNull(), NULL_USER_ID)
    df = df.withColumn("_signup", parse_date("signup_date", USERS_DATE_FORMATS))
    df = reject_if(df, F.col("_signup").isNull(), INVALID_SIGNUP_DATE)
    # Keep-first reads its input twice (first copy per key, then the join back): stage it.
    df = stage(reject_duplicates(stage(df), "user_id", DUPLICATE_USER_ID, audit=audit_duplicates))
    clean = [F.col("user_id"), F.col("name"), F.col("gender"),
             to_int_half_even(_number("users", "age")).alias("age"),
             F.col("_signup").alias("signup_date"), F.col("city")]
    return split(df, clean, BRONZE_COLUMNS["users"], run_ts, "user_id")


def clean_captains(bronze: DataFrame, run_ts: datetime | None = None,
                   stage: Stage = parquet_stage) -> CleanResult:
    """Null id -> keep first -> coerce age/rating -> fill+trim city -> median fill
    (age truncated, rating half-even to 1 dp) -> reject blank name (after the medians)."""
    df = _raw(bronze, "captains", skip=("experience_years",))
    df = reject_if(df, F.col("captain_id").isNull(), NULL_CAPTAIN_ID)
    df = reject_duplicates(stage(df), "captain_id", DUPLICATE_CAPTAIN_ID)
    df = stage(df.withColumn("_age", _number("captains", "age"))
               .withColumn("_rating", _number("captains", "rating")))
    survivors = alive(df)
    med_age, med_rating = medians_of(survivors, "_age", "_rating")
    df = (df.withColumn("_age", truncate_int(F.coalesce(F.col("_age"), med_age)))
            .withColumn("_rating", F.bround(F.coalesce(F.col("_rating"), med_rating), 1)))
    df = reject_if(df, is_blank("name"), NULL_OR_EMPTY_NAME)
    clean = [F.col("captain_id"), F.col("name"), F.col("_age").alias("age"),
             F.lit(None).cast("int").alias("experience_years"),
             strip_ws(F.coalesce(F.col("city"), F.lit(UNKNOWN))).alias("city"),
             F.col("_rating").try_cast("decimal(3,2)").alias("rating")]
    return split(df, clean, BRONZE_COLUMNS["captains"], run_ts, "captain_id")


def clean_rides(bronze: DataFrame, users: DataFrame, captains: DataFrame,
                run_ts: datetime | None = None, stage: Stage = parquet_stage) -> CleanResult:
    """Blank keys -> date -> user and captain membership -> keep first -> median fill of
    distance/duration -> fill locations -> mode fill of status."""
    df = start(bronze)
    df = reject_if(df, is_blank("ride_id"), NULL_OR_EMPTY_RIDE_ID)
    df = reject_if(df, is_blank("user_id"), NULL_OR_EMPTY_USER_ID)
    df = reject_if(df, is_blank("captain_id"), NULL_OR_EMPTY_CAPTAIN_ID)
    df = df.withColumn("_date", parse_date("ride_date", RIDES_DATE_FORMATS, trim=True))
    df = reject_if(df, F.col("_date").isNull(), NULL_OR_INVALID_RIDE_DATE)
    df = reject_orphans(df, "user_id", users, "user_id", USER_NOT_IN_USERS)
    df = reject_orphans(df, "captain_id", captains, "captain_id", CAPTAIN_NOT_IN_CAPTAINS)
    df = _typed(df, "rides", {"distance_km": "_dist", "duration_min": "_dur"}, {"distance_km": "_km"})
    df = stage(_audited_text(reject_duplicates(stage(df), "ride_id", DUPLICATE_RIDE_ID),
                             "ride_date", "distance_km", "duration_min"))
    survivors = alive(df)
    med_dist, med_dur = medians_of(survivors, "_dist", "_dur")
    status_mode = F.coalesce(mode_of(survivors, "ride_status"), F.lit(UNKNOWN))
    clean = [F.col("ride_id"), F.col("user_id"), F.col("captain_id"),
             F.col("_date").alias("ride_date"),
             fill_text("pickup_loc", UNKNOWN).alias("pickup_loc"),
             fill_text("drop_loc", UNKNOWN).alias("drop_loc"),
             F.coalesce(F.col("_km"), med_dist.cast("decimal(7,2)")).alias("distance_km"),
             to_int_half_even(F.coalesce(F.col("_dur"), med_dur)).alias("duration_min"),
             F.coalesce(F.col("ride_status"), status_mode).alias("ride_status")]
    return split(df, clean, BRONZE_COLUMNS["rides"], run_ts, "ride_id")


def clean_payments(bronze: DataFrame, rides: DataFrame,
                   run_ts: datetime | None = None, stage: Stage = parquet_stage) -> CleanResult:
    """Blank ride -> ride membership -> median fill of fare -> zero fill of discounts."""
    df = start(bronze)
    df = reject_if(df, is_blank("ride_id"), NULL_OR_EMPTY_RIDE_ID)
    df = reject_orphans(df, "ride_id", rides, "ride_id", PAYMENT_RIDE_NOT_IN_RIDES, many_keys=True)
    numbers = ["fare", "discount_percent", "discount_amount", "final_amount"]
    df = _typed(df, "payments", {"fare": "_fare"}, {c: f"_{c}_typed" for c in numbers})
    df = stage(_audited_text(df, *numbers))
    [med_fare] = medians_of(alive(df), "_fare")

    def filled(column: str, fill, target: str):
        return F.coalesce(F.col(f"_{column}_typed"), fill.cast(target)).alias(column)
    zero = F.lit(0.0)
    clean = [F.col("payment_id"), F.col("ride_id"), F.col("payment_method"),
             filled("fare", med_fare, "decimal(10,2)"), filled("discount_percent", zero, "decimal(5,2)"),
             filled("discount_amount", zero, "decimal(10,2)"), filled("final_amount", zero, "decimal(10,2)"),
             F.col("payment_status")]
    return split(df, clean, BRONZE_COLUMNS["payments"], run_ts, "payment_id")


def clean_feedback(bronze: DataFrame, rides: DataFrame,
                   run_ts: datetime | None = None, stage: Stage = parquet_stage) -> CleanResult:
    """Blank feedback id -> blank ride -> ride membership -> median fill of both ratings
    -> constant fill of issue and comment ('' counts as missing)."""
    df = start(bronze)
    df = reject_if(df, is_blank("feedback_id"), NULL_OR_EMPTY_FEEDBACK_ID)
    df = reject_if(df, is_blank("ride_id"), NULL_OR_EMPTY_RIDE_ID)
    df = reject_orphans(df, "ride_id", rides, "ride_id", FEEDBACK_RIDE_NOT_IN_RIDES, many_keys=True)
    df = stage(_typed(df, "feedback", {"user_rating": "_ur", "captain_rating": "_cr"},
                      {"user_rating": "_ur_typed", "captain_rating": "_cr_typed"}))
    survivors = alive(df)
    med_ur, med_cr = medians_of(survivors, "_ur", "_cr")
    clean = [F.col("feedback_id"), F.col("ride_id"),
             F.coalesce(F.col("_ur_typed"), med_ur.cast("decimal(2,1)")).alias("user_rating"),
             F.coalesce(F.col("_cr_typed"), med_cr.cast("decimal(2,1)")).alias("captain_rating"),
             fill_text("issue_category", NO_ISSUES).alias("issue_category"),
             fill_text("comments", NO_COMMENTS).alias("comments")]
    return split(df, clean, BRONZE_COLUMNS["feedback"], run_ts, "feedback_id")


def build_silver(bronze: dict[str, DataFrame], run_ts: datetime | None = None,
                 stage: Stage = parquet_stage) -> dict[str, CleanResult]:
    """users, captains -> rides -> payments, feedback.

    ``stage`` materialises each labelled frame once (default: reliable checkpoint), so
    the imputation statistics, the clean output, the rejects and the membership checks
    of the dependent jobs all read it instead of re-running the upstream plan.
    """
    ts = run_ts or datetime.now()
    out: dict[str, CleanResult] = {}
    out["users"] = clean_users(bronze["users"], ts, stage=stage)
    out["captains"] = clean_captains(bronze["captains"], ts, stage=stage)
    out["rides"] = clean_rides(bronze["rides"], out["users"].clean, out["captains"].clean, ts,
                               stage=stage)
    rides = out["rides"].clean
    out["payments"] = clean_payments(bronze["payments"], rides, ts, stage=stage)
    out["feedback"] = clean_feedback(bronze["feedback"], rides, ts, stage=stage)
    return out
