"""Registered queries: one per operator or product, each ``(spark, sf_dir) -> DataFrame``
over the benchmark tables mapped to the five ride-hailing entities.

Results are made engine-neutral at the very end (dates and timestamps as ISO text,
decimals as double, doubles rounded to 6 places) so they compare cell for cell with the
SQL oracle in ``kiln.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.exprs import (
    RIDES_DATE_FORMATS, USERS_DATE_FORMATS, fill_text, is_blank, parse_date, strip_ws,
    to_number, truncate_int,
)
from kiln.operators import expectations as X
from kiln.operators.aggregates import avg_nonzero, exact_medians, medians_of, mode_by, mode_of
from kiln.operators.conform import conform
from kiln.operators.joins import full_join_lookup, left_join_many
from kiln.operators.quarantine import (
    REASON, alive, reject_duplicates, reject_if, reject_orphans, start, union_rejects,
)
from kiln.plans import entities as E
from kiln.plans import gold as G
from kiln.plans import pipeline as P
from kiln.plans import reconcile as R
from kiln.plans.drilldown import drill_down
from kiln.schemas import TABLES
from kiln.session import ensure_checkpoint_dir, staging_root
from kiln.sources import testdata as TD
from kiln.sources.csv import (
    CSV_DIALECT, DEFAULT_NULL_TOKENS, line_audit, loaded, read_lines, read_raw_csv,
)
from kiln.sources.sinks import (
    LayerRun, export_csv, layer_tables, publish_snapshot, read_layer, write_bucketed,
)
from kiln.streaming.keep_first import keep_first_stream, read_first

AS_OF = "2001-08-01"
RUN_TS = datetime(2001, 8, 1, 0, 0, 0)

_SILVER: dict[tuple, dict] = {}


def silver(spark: SparkSession, sf_dir: str) -> dict[str, E.CleanResult]:
    """Silver + audit for ``sf_dir`` built once per session (checkpointed stages)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SILVER:
        ensure_checkpoint_dir(spark)
        _SILVER[key] = E.build_silver(TD.bronze_tables(spark, sf_dir), RUN_TS)
    return _SILVER[key]


def reset_cache() -> None:
    _SILVER.clear()


def _clean(spark, d):
    s = silver(spark, d)
    return {n: r.clean for n, r in s.items()}


def presentable(df: DataFrame) -> DataFrame:
    """Engine-neutral cell types for cross-engine comparison."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- gold products
def q_captain_aggregate(spark, d):
    s = _clean(spark, d)
    return G.captain_aggregate(s["captains"], s["rides"], s["payments"], s["feedback"])


def q_user_aggregate(spark, d):
    s = _clean(spark, d)
    return G.user_aggregate(s["users"], s["rides"], s["payments"], s["feedback"], AS_OF)


def q_dashboard_data(spark, d):
    s = _clean(spark, d)
    return G.dashboard(s["users"], s["rides"], s["payments"], s["feedback"], s["captains"], users_first=True)


def co_bucketed(spark, d) -> dict[str, DataFrame]:
    """Silver with rides, payments and feedback in buckets of the ride."""
    root = _scratch(spark, "buckets")
    return {n: write_bucketed(df, f"{root}/{n}", "ride_id")[0] if n in P.BY_RIDE else df
            for n, df in _clean(spark, d).items()}


def q_dashboard_bucketed(spark, d):
    """The dashboard from co-bucketed silver: no exchange between rides, payments, feedback."""
    s = co_bucketed(spark, d)
    return G.dashboard(s["users"], s["rides"], s["payments"], s["feedback"], s["captains"])


def q_dashboard_fanout(spark, d):
    s = _clean(spark, d)
    return G.dashboard_fanout_size(s["users"], s["rides"], s["payments"], s["feedback"], s["captains"])


def _user_report(s):
    ua = G.user_aggregate(s["users"], s["rides"], s["payments"], s["feedback"], AS_OF)
    return R.compare(R.user_metrics_silver(s["rides"], s["payments"], s["feedback"], AS_OF),
                     R.user_metrics_gold(ua), "User")


def _captain_report(s):
    ca = G.captain_aggregate(s["captains"], s["rides"], s["payments"], s["feedback"])
    return R.compare(R.captain_metrics_silver(s["captains"], s["rides"], s["payments"], s["feedback"]),
                     R.captain_metrics_gold(ca), "Captain")


def q_reconcile_users(spark, d):
    return _user_report(_clean(spark, d))


def q_reconcile_captains(spark, d):
    return _captain_report(_clean(spark, d))


def q_reconcile_report(spark, d):
    s = _clean(spark, d)
    return R.report(_user_report(s), _captain_report(s))


# ---------------------------------------------------------------- cleaning jobs
def _clean_q(name):
    def q(spark, d):
        return silver(spark, d)[name].clean
    q.__name__ = f"q_clean_{name}"
    return q


def _audit_q(name):
    def q(spark, d):
        return silver(spark, d)[name].rejects.drop("run_ts")
    q.__name__ = f"q_audit_{name}"
    return q


def q_rejects_by_reason(spark, d):
    s = silver(spark, d)
    parts = [r.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(n).alias("table_name"), "reason", "n") for n, r in s.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- rule operators
def _b(spark, d, name):
    return TD.BRONZE_BUILDERS[name](spark, d)


def q_reject_null_keys(spark, d):
    """Q1 (null only) on captains, Q8 blank name on the survivors."""
    df = start(_b(spark, d, "captains"))
    df = reject_if(df, F.col("captain_id").isNull(), E.NULL_CAPTAIN_ID)
    df = reject_if(df, is_blank("name"), E.NULL_OR_EMPTY_NAME)
    return df.select("captain_id", "name", "_seq", REASON)


def q_reject_blank_keys(spark, d):
    """Q2 on the three ride keys, first failing rule wins."""
    df = start(_b(spark, d, "rides"))
    for c, why in [("ride_id", E.NULL_OR_EMPTY_RIDE_ID), ("user_id", E.NULL_OR_EMPTY_USER_ID),
                   ("captain_id", E.NULL_OR_EMPTY_CAPTAIN_ID)]:
        df = reject_if(df, is_blank(c), why)
    return df.select("ride_id", "user_id", "captain_id", "_seq", REASON)


def q_parse_dates_users(spark, d):
    b = _b(spark, d, "users")
    return b.select("_seq", "signup_date", parse_date("signup_date", USERS_DATE_FORMATS).alias("parsed"))


def q_parse_dates_rides(spark, d):
    b = _b(spark, d, "rides")
    return b.select("_seq", "ride_date", parse_date("ride_date", RIDES_DATE_FORMATS, trim=True).alias("parsed"))


def q_reject_bad_dates(spark, d):
    u = _b(spark, d, "users")
    r = _b(spark, d, "rides")
    bu = u.where(parse_date("signup_date", USERS_DATE_FORMATS).isNull()).select(
        F.lit("users").alias("table_name"), "_seq", F.col("signup_date").alias("raw_date"),
        F.lit(E.INVALID_SIGNUP_DATE).alias(REASON))
    br = r.where(parse_date("ride_date", RIDES_DATE_FORMATS, trim=True).isNull()).select(
        F.lit("rides").alias("table_name"), "_seq", F.col("ride_date").alias("raw_date"),
        F.lit(E.NULL_OR_INVALID_RIDE_DATE).alias(REASON))
    return bu.unionByName(br)


def q_orphans(spark, d):
    s = _clean(spark, d)
    df = start(_b(spark, d, "rides"))
    df = reject_orphans(df, "user_id", s["users"], "user_id", E.USER_NOT_IN_USERS)
    df = reject_orphans(df, "captain_id", s["captains"], "captain_id", E.CAPTAIN_NOT_IN_CAPTAINS)
    return df.where(F.col(REASON).isNotNull()).select("ride_id", "user_id", "captain_id", "_seq", REASON)


def q_referential_keep(spark, d):
    s = _clean(spark, d)
    return _b(spark, d, "payments").join(s["rides"].select("ride_id"), "ride_id", "left_semi") \
        .select("payment_id", "ride_id", "fare")


def _lineitem_labelled(spark, d):
    li = TD.read_table(spark, d, "lineitem")
    li = li.withColumn("_k", F.struct("l_orderkey", "l_linenumber")).withColumn(
        "_seq", F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"))
    return reject_duplicates(start(li), "_k", "duplicate_line")


def q_dedupe_keep_first(spark, d):
    return alive(_lineitem_labelled(spark, d)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def q_dedupe_rejects(spark, d):
    return _lineitem_labelled(spark, d).where(F.col(REASON).isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", REASON)


def q_coerce_numeric(spark, d):
    b = _b(spark, d, "payments")
    return b.select("payment_id", "discount_amount", to_number("discount_amount").alias("value"),
                    "fare", to_number("fare").alias("fare_value"))


def q_impute_median(spark, d):
    b = _b(spark, d, "feedback").withColumn("_v", to_number("user_rating"))
    return b.select("_seq", "user_rating", F.coalesce(F.col("_v"), *medians_of(b, "_v")).alias("value"))


def q_impute_mode(spark, d):
    b = _b(spark, d, "rides")
    mode = F.coalesce(mode_of(b, "ride_status"), F.lit(E.UNKNOWN))
    return b.select("_seq", "ride_status", F.coalesce(F.col("ride_status"), mode).alias("value"))


def q_impute_const(spark, d):
    b = _b(spark, d, "feedback")
    p = _b(spark, d, "payments")
    fb = b.select(F.col("_seq").cast("string").alias("row_id"),
                  fill_text("issue_category", E.NO_ISSUES).alias("text_a"),
                  fill_text("comments", E.NO_COMMENTS).alias("text_b"),
                  F.lit(None).cast("double").alias("number"))
    pay = p.select(F.col("payment_id").alias("row_id"), F.lit(None).cast("string").alias("text_a"),
                   F.lit(None).cast("string").alias("text_b"),
                   F.coalesce(to_number("discount_percent"), F.lit(0.0)).alias("number"))
    return fb.unionByName(pay)


def q_round_truncate(spark, d):
    b = _b(spark, d, "captains")
    r = to_number("rating")
    return b.select("_seq", truncate_int(to_number("age") / 3).alias("age_third"),
                    F.bround(r / 2, 1).alias("half_rating_1dp"), F.bround(r, 1).alias("rating_1dp"))


def q_trim_text(spark, d):
    b = _b(spark, d, "captains")
    return b.select("_seq", "city", strip_ws(F.coalesce(F.col("city"), F.lit(E.UNKNOWN))).alias("clean_city"))


def q_expectation_violations(spark, d):
    s = _clean(spark, d)
    parts = [X.violations(s[n], n, TABLES[n].checks, s) for n in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Tighter limits than the declared ones, so that rides, payments and feedback fall with their
#: users and captains.
STRICT_CHECKS = {"users": [X.Check("range", "age", 21)], "captains": [X.Check("range", "rating", 0.3, 5)],
                 "rides": [X.Check("range", "distance_km", 0, 40)],
                 "payments": [X.Check("range", "fare", 0, 90000)], "feedback": []}


def q_quarantine_violations(spark, d):
    """Every row that the constraints take out of silver, its own fault or its parents'."""
    found = X.quarantine(_clean(spark, d), {n: [*STRICT_CHECKS[n], *t.checks] for n, t in TABLES.items()},
                         E.parquet_stage)
    parts = [found.rejected[n].select(F.lit(n).alias("table_name"), F.col(t.key).alias("row_key"),
                                      "reason", "depth") for n, t in TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def q_quarantine_kept(spark, d):
    """What the constraints leave: rows and distinct keys per table, every check of which holds."""
    checks = {n: [*STRICT_CHECKS[n], *t.checks] for n, t in TABLES.items()}
    kept = {n: E.parquet_stage(k) for n, k in X.quarantine(_clean(spark, d), checks, E.parquet_stage).kept.items()}
    counts = [kept[n].agg(F.count("*").alias("kept_rows"), F.count_distinct(t.key).alias("kept_keys"))
              .withColumn("table_name", F.lit(n)) for n, t in TABLES.items()]
    left = reduce(DataFrame.unionByName, [X.violations(kept[n], n, checks[n], kept) for n in TABLES])
    return reduce(DataFrame.unionByName, counts).join(
        left.groupBy("table_name").agg(F.sum("violations").alias("violations")), "table_name")


def _users_with_bad_ages(spark, d):
    k = F.col("_seq")
    return _b(spark, d, "users").withColumn(
        "age", F.when(k % 61 == 0, F.lit("99999999999")).when(k % 59 == 0, F.lit(" abc"))
        .when(k % 67 == 0, F.lit("1e999")).when(k % 71 == 0, F.lit(" ")).otherwise(F.col("age")))


def q_cast_rejects(spark, d):
    """Cells of surviving rows that their typed column cannot hold, of all five tables."""
    s = silver(spark, d)
    cells = {n: r.cells for n, r in s.items()}
    cells["users"] = E.clean_users(_users_with_bad_ages(spark, d), RUN_TS).cells
    return reduce(DataFrame.unionByName, [
        c.select(F.lit(n).alias("table_name"), "row_key", "column_name", "raw_text", "target_type",
                 "problem") for n, c in cells.items()])


def q_conform_types(spark, d):
    b = _b(spark, d, "rides").select("ride_id", "user_id", "captain_id", "distance_km", "duration_min")
    return conform(b, TABLES["rides"]).select("ride_id", "distance_km", "duration_min")


# ---------------------------------------------------------------- joins
def q_left_join_rides(spark, d):
    s = _clean(spark, d)
    return left_join_many(s["users"].select("user_id", "name"),
                          s["rides"].select("ride_id", "user_id", "ride_date"), "user_id")


def q_inner_join_payments(spark, d):
    s = _clean(spark, d)
    return s["payments"].select("payment_id", "ride_id", "final_amount") \
        .join(s["rides"].select("ride_id", "ride_status"), "ride_id", "inner")


def q_full_outer_captains(spark, d):
    s = _clean(spark, d)
    r = s["rides"].select("ride_id", "captain_id")
    c = s["captains"].select(F.col("captain_id").alias("cap_id"), F.col("name").alias("captain_name"))
    return full_join_lookup(r, c, "captain_id", "cap_id")


def q_semi_join(spark, d):
    s = _clean(spark, d)
    return s["rides"].join(s["feedback"], "ride_id", "left_semi").select("ride_id", "captain_id")


def q_anti_join(spark, d):
    s = _clean(spark, d)
    return s["rides"].join(s["payments"], "ride_id", "left_anti").select("ride_id", "user_id")


# ---------------------------------------------------------------- aggregates
def q_count_filter(spark, d):
    s = _clean(spark, d)
    return s["rides"].groupBy("captain_id").agg(
        F.count_if(F.col("ride_status") == G.COMPLETED).alias("completed_rides"),
        F.count_if(F.col("ride_status") == G.CANCELLED).alias("cancelled_rides"),
        F.count(F.lit(1)).alias("all_rides"))


def q_count_distinct(spark, d):
    s = _clean(spark, d)
    return s["rides"].groupBy("ride_status").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("captain_id").alias("captains"))


def q_sum_coalesce(spark, d):
    s = _clean(spark, d)
    per_ride = s["rides"].select("ride_id", "user_id").join(G.ride_payment_totals(s["payments"]), "ride_id", "left")
    return per_ride.groupBy("user_id").agg(
        F.coalesce(F.sum("total_payment"), F.lit(0)).alias("revenue"),
        F.sum(F.coalesce(F.col("total_payment"), F.lit(0))).alias("revenue_zero_filled"))


def q_avg_nullif(spark, d):
    s = _clean(spark, d)
    fr = s["feedback"].join(s["rides"].select("ride_id", "captain_id"), "ride_id")
    return fr.groupBy("captain_id").agg(avg_nonzero("captain_rating").alias("avg_captain_rating"),
                                        avg_nonzero("user_rating").alias("avg_user_rating"))


def q_min_max_dates(spark, d):
    s = _clean(spark, d)
    return s["rides"].groupBy("user_id").agg(F.min("ride_date").alias("first_ride_date"),
                                             F.max("ride_date").alias("last_ride_date"))


def q_mode_within_group(spark, d):
    s = _clean(spark, d)
    fr = s["feedback"].join(s["rides"].select("ride_id", "captain_id"), "ride_id")
    return mode_by(fr, ["captain_id"], "issue_category", "most_frequent_issue")


def q_weighted_avg(spark, d):
    ua = q_user_aggregate(spark, d)
    return ua.groupBy("gender").agg(
        F.try_divide(F.sum(F.col("avg_revenue_per_ride") * F.col("total_rides")),
                     F.nullif(F.sum("total_rides"), F.lit(0))).alias("avg_revenue_per_ride"))


def q_two_level_agg(spark, d):
    s = _clean(spark, d)
    per_ride = s["feedback"].groupBy("ride_id").agg(avg_nonzero("captain_rating").alias("ride_avg"))
    return s["rides"].join(per_ride, "ride_id", "left").groupBy("captain_id").agg(
        F.avg("ride_avg").alias("avg_of_ride_avgs"), F.count("ride_avg").alias("rated_rides"))


def q_guarded_ratio(spark, d):
    ua = q_user_aggregate(spark, d)
    return ua.select("user_id", "total_rides", "avg_revenue_per_ride")


def q_active_flag(spark, d):
    ua = q_user_aggregate(spark, d)
    ca = q_captain_aggregate(spark, d)
    return ua.select(F.lit("user").alias("entity"), "user_id", F.col("is_active").cast("string").alias("flag")) \
        .unionByName(ca.select(F.lit("captain").alias("entity"), F.col("captain_id").alias("user_id"),
                               F.col("status").alias("flag")))


def q_recent_30_days(spark, d):
    s = _clean(spark, d)
    return s["rides"].where(F.col("ride_date") >= G.recent_cutoff(AS_OF)).groupBy("user_id") \
        .agg(F.count(F.lit(1)).alias("booking_frequency"))


def q_median_global(spark, d):
    found = {**exact_medians(_b(spark, d, "rides"), {"distance_km": to_number("distance_km")}),
             **exact_medians(_b(spark, d, "payments"), {"fare": to_number("fare")})}
    return spark.createDataFrame(list(found.items()), "column_name string, median_value double")


def q_mode_global(spark, d):
    r = _b(spark, d, "rides")
    s = _clean(spark, d)
    a = mode_by(r, [], "ride_status", "mode_value").select(F.lit("ride_status").alias("column_name"), "mode_value")
    b = mode_by(s["feedback"], [], "issue_category", "mode_value").select(
        F.lit("issue_category").alias("column_name"), "mode_value")
    return a.unionByName(b)


def q_union_by_name(spark, d):
    s = silver(spark, d)
    return union_rejects(s["users"].rejects, s["captains"].rejects).drop("run_ts")


def q_sort_nulls_last(spark, d):
    ca = q_captain_aggregate(spark, d)
    return ca.orderBy(F.col("most_frequent_issue").asc_nulls_last(), F.col("captain_id").asc_nulls_last()) \
        .select("captain_id", "most_frequent_issue", "total_rides")


# ---------------------------------------------------------------- sources / sinks
def _scratch(spark, name):
    return staging_root(spark, f"{name}-{uuid.uuid4().hex}")


def _csv_writer(df, mode="overwrite"):
    # Keep cells byte-exact: no whitespace trimming on write.
    return (df.write.mode(mode).options(**CSV_DIALECT)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def q_bronze_roundtrip(spark, d):
    """Bronze rides written as text CSV and read back through the raw ingest."""
    path = _scratch(spark, "bronze-rides")
    b = _b(spark, d, "rides")
    _csv_writer(b.drop("_seq")).csv(path)
    back = read_raw_csv(spark, path, TABLES["rides"].bronze_schema(), null_tokens=[""])
    return back.drop("_seq")


def q_csv_null_tokens(spark, d):
    """All five tables as CSV folders whose files have two column orders and whose nulls are
    written as any of the null tokens; nulls come back as nulls, cells under their names."""
    parts = []
    for n, spec in TABLES.items():
        path, b = _scratch(spark, f"null-tokens-{n}"), _b(spark, d, n)
        tokens = F.array(*[F.lit(t) for t in DEFAULT_NULL_TOKENS])
        cells = [F.coalesce(F.col(c), F.element_at(tokens, (F.pmod(F.hash("_seq"), len(DEFAULT_NULL_TOKENS)) + i)
                                                   % len(DEFAULT_NULL_TOKENS) + 1)).alias(c)
                 for i, c in enumerate(spec.bronze_columns)]
        odd = F.col("_seq") % 2 == 1
        _csv_writer(b.where(odd).select(*cells)).csv(path)
        _csv_writer(b.where(~odd).select(*cells[::-1], F.lit("x").alias("extra")), "append").csv(path)
        back = read_raw_csv(spark, path, spec.bronze_schema(), multi_line=n == "feedback")
        parts.append(back.select(F.lit(n).alias("table_name"), F.concat_ws("|", *[
            F.coalesce(F.col(c), F.lit("<null>")) for c in spec.bronze_columns]).alias("cells")))
    return reduce(DataFrame.unionByName, parts)


def _users_with_torn_lines(spark, d):
    k = F.col("_seq") % 60
    cells = [F.coalesce(F.col(c), F.lit("")) for c in TABLES["users"].bronze_columns]
    short = F.concat_ws(",", *cells[:4])
    return _b(spark, d, "users").select(F.when(k == 7, F.concat_ws(",", *cells, F.lit("EXTRA")))
                                        .when(k == 9, short).otherwise(F.concat_ws(",", *cells))
                                        .alias(",".join(TABLES["users"].bronze_columns)))


def q_csv_line_audit(spark, d):
    """Lines with a surplus cell or without the last ones: audited, the short ones loaded."""
    path = _scratch(spark, "torn-lines")
    _users_with_torn_lines(spark, d).write.option("header", True).option("sep", "\x01") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    lines = E.parquet_stage(read_lines(spark, path, TABLES["users"].bronze_schema()))
    count = lambda df: df.agg(F.count("*").alias("n"))
    total = count(loaded(lines)).select(F.lit("loaded").alias("problem"), F.lit(None).cast("string").alias("raw_line"),
                                        F.lit(True).alias("loaded"), F.col("n").alias("rows"))
    return line_audit(lines).select("problem", "raw_line", "loaded", F.lit(1).cast("long").alias("rows")).unionByName(total)


def q_export_snapshot(spark, d):
    """Publish the captain aggregate as a CSV snapshot and read the snapshot back, all columns."""
    root = _scratch(spark, "export")
    ca = E.parquet_stage(q_captain_aggregate(spark, d))
    path = publish_snapshot(ca, root, "captains_data")
    back = spark.read.options(**CSV_DIALECT).csv(path)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in ca.schema.fields])


def q_full_refresh(spark, d):
    """A layer after two published runs and one that ended before it was published: the second."""
    root, ca = _scratch(spark, "refresh"), E.parquet_stage(q_captain_aggregate(spark, d))
    for n, table in enumerate([ca.withColumn("status", F.lit("first run")), ca,
                               ca.withColumn("status", F.lit("never published"))]):
        run = LayerRun(spark, root, "gold", str(n))
        run.write(table, "captain_aggregate")
        if n < 2:
            run.publish()
    return read_layer(spark, root, "gold", "captain_aggregate")


def q_load_counts(spark, d):
    """Rows of all silver and audit tables as their writes saw them, and as scans find them."""
    root, out = _scratch(spark, "counts"), []
    for layer in ("silver", "audit"):
        run = LayerRun(spark, root, layer, "1")
        written = {n: run.write(r.clean if layer == "silver" else r.rejects, n)["rows"]
                   for n, r in silver(spark, d).items()}
        run.publish()
        for n in layer_tables(spark, root, layer):
            rows = read_layer(spark, root, layer, n)
            out.append(rows.agg(F.count("*").alias("scanned_rows")).select(
                F.lit(layer).alias("layer"), F.lit(n).alias("table_name"),
                F.lit(written[n]).cast("long").alias("written_rows"), "scanned_rows"))
    return reduce(DataFrame.unionByName, out)


def q_run_stamp(spark, d):
    """The run's one timestamp on every audit row (F9)."""
    return reduce(DataFrame.unionByName, [
        r.rejects.groupBy("run_ts").agg(F.count("*").alias("rejected"))
        .select(F.lit(n).alias("table_name"), "run_ts", "rejected") for n, r in silver(spark, d).items()])


def _observed_report(spark, d):
    """Silver and gold written to a scratch warehouse, reconciled by what the writes saw."""
    root = _scratch(spark, "observed")
    runs = {n: LayerRun(spark, root, n, "1") for n in ("silver", "gold")}
    seen, written = {}, {}

    def write(layer, table, df, metrics=None):
        seen[table] = runs[layer].write(df, table, metrics)
        return runs[layer].read(table)
    for n, df in _clean(spark, d).items():
        written[n] = write("silver", n, df, R.write_metrics(n, AS_OF))
    return P.gold_and_report(spark, written, dict(seen), write, AS_OF)[2]


def q_reconcile_observed(spark, d):
    return _observed_report(spark, d)


def q_report_csv(spark, d):
    """The report as its CSV file has it: lines in the order of the metrics."""
    path = _scratch(spark, "report")
    export_csv(R.report_text(q_reconcile_report(spark, d)), path, single_file=True, order_by=["_position"])
    columns = ["Metric", "Silver", "Gold", "Difference", "Status", "Entity"]
    back = read_raw_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]), null_tokens=[""])
    number = lambda c: F.round(F.col(c).try_cast("double"), 6).alias(c)
    line = F.row_number().over(Window.orderBy("_seq"))  # the report has a line for each metric
    return back.select(line.alias("line"), "Metric", number("Silver"), number("Gold"), "Status", "Entity")


def q_reconcile_drilldown(spark, d):
    """Per captain, silver totals against a gold table with planted faults: one captain in 17
    paid too much and the next too little by as much, one in 19 missing, one in 23 twice."""
    s = _clean(spark, d)
    gold = q_captain_aggregate(spark, d)
    k = F.coalesce(F.col("captain_id").try_cast("long"), F.lit(-1))
    faulty = (gold.where(k % 19 != 0).unionByName(gold.where(k % 23 == 0))
              .withColumn("total_final_amount", F.col("total_final_amount") + F.when(k % 17 == 0, 5)
                          .when(k % 17 == 1, -5).otherwise(0)))
    mine = s["rides"].join(G.ride_payment_totals(s["payments"]), "ride_id", "left").groupBy("captain_id").agg(
        F.count("*").alias("total_rides"), F.sum("distance_km").alias("total_distance_km"),
        F.sum(F.coalesce("total_payment", F.lit(0))).alias("total_final_amount"))
    measures = ["total_rides", "total_distance_km", "total_final_amount"]
    everyone = s["captains"].select("captain_id").join(mine, "captain_id", "left").na.fill(0, measures)
    return drill_down(everyone, faulty, "captain_id", measures, E.parquet_stage)


def q_dashboard_fanout_page(spark, d):
    """Three pages of the multiplying dashboard, from its beginning, middle and end."""
    s = _clean(spark, d)
    whole = G.dashboard_fanout(s["users"], s["rides"], s["payments"], s["feedback"], s["captains"],
                               users_first=True)
    pages = [(0, 400), (whole.size // 2, whole.size // 2 + 400), (whole.size - 400, whole.size)]
    return reduce(DataFrame.unionByName, [whole.page(max(a, 0), b) for a, b in pages]).select(
        "row_no", "captain_ride_id", *G.DASHBOARD_COLUMNS)


def q_dedupe_incremental(spark, d):
    """Line items landed in four batches, late copies first, kept by the stream's state."""
    li = TD.read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    land, out = _scratch(spark, "landed-lines"), _scratch(spark, "first-lines")
    late = F.pmod(F.hash("l_extendedprice", "l_partkey"), F.lit(4))
    for n in range(4):
        li.where(late == n).write.mode("append").parquet(land)
        keep_first_stream(spark.readStream.schema(li.schema).parquet(land), ["l_orderkey", "l_linenumber"],
                          ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"], out)
    return read_first(spark, out, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "copies")


def _p(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(fn(spark, sf_dir))
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "captain_aggregate": _p(q_captain_aggregate),
    "user_aggregate": _p(q_user_aggregate),
    "dashboard_data": _p(q_dashboard_data),
    "dashboard_bucketed": _p(q_dashboard_bucketed),
    "dashboard_fanout": _p(q_dashboard_fanout),
    "reconcile_users": _p(q_reconcile_users),
    "reconcile_captains": _p(q_reconcile_captains),
    "reconcile_report": _p(q_reconcile_report),
    **{f"clean_{n}": _p(_clean_q(n)) for n in TABLES},
    **{f"audit_{n}": _p(_audit_q(n)) for n in TABLES},
    "rejects_by_reason": _p(q_rejects_by_reason),
    "reject_null_keys": _p(q_reject_null_keys),
    "reject_blank_keys": _p(q_reject_blank_keys),
    "parse_dates_users": _p(q_parse_dates_users),
    "parse_dates_rides": _p(q_parse_dates_rides),
    "reject_bad_dates": _p(q_reject_bad_dates),
    "orphans": _p(q_orphans),
    "referential_keep": _p(q_referential_keep),
    "dedupe_keep_first": _p(q_dedupe_keep_first),
    "dedupe_rejects": _p(q_dedupe_rejects),
    "coerce_numeric": _p(q_coerce_numeric),
    "impute_median": _p(q_impute_median),
    "impute_mode": _p(q_impute_mode),
    "impute_const": _p(q_impute_const),
    "round_truncate": _p(q_round_truncate),
    "trim_text": _p(q_trim_text),
    "expectation_violations": _p(q_expectation_violations),
    "quarantine_violations": _p(q_quarantine_violations),
    "quarantine_kept": _p(q_quarantine_kept),
    "cast_rejects": _p(q_cast_rejects),
    "conform_types": _p(q_conform_types),
    "left_join_rides": _p(q_left_join_rides),
    "inner_join_payments": _p(q_inner_join_payments),
    "full_outer_captains": _p(q_full_outer_captains),
    "semi_join": _p(q_semi_join),
    "anti_join": _p(q_anti_join),
    "count_filter": _p(q_count_filter),
    "count_distinct": _p(q_count_distinct),
    "sum_coalesce": _p(q_sum_coalesce),
    "avg_nullif": _p(q_avg_nullif),
    "min_max_dates": _p(q_min_max_dates),
    "mode_within_group": _p(q_mode_within_group),
    "weighted_avg": _p(q_weighted_avg),
    "two_level_agg": _p(q_two_level_agg),
    "guarded_ratio": _p(q_guarded_ratio),
    "active_flag": _p(q_active_flag),
    "recent_30_days": _p(q_recent_30_days),
    "median_global": _p(q_median_global),
    "mode_global": _p(q_mode_global),
    "union_by_name": _p(q_union_by_name),
    "sort_nulls_last": _p(q_sort_nulls_last),
    "bronze_roundtrip": _p(q_bronze_roundtrip),
    "csv_null_tokens": _p(q_csv_null_tokens),
    "csv_line_audit": _p(q_csv_line_audit),
    "export_snapshot": _p(q_export_snapshot),
    "full_refresh": _p(q_full_refresh),
    "load_counts": _p(q_load_counts),
    "run_stamp": _p(q_run_stamp),
    "reconcile_observed": _p(q_reconcile_observed),
    "report_csv": _p(q_report_csv),
    "reconcile_drilldown": _p(q_reconcile_drilldown),
    "dashboard_fanout_page": _p(q_dashboard_fanout_page),
    "dedupe_incremental": _p(q_dedupe_incremental),
}
