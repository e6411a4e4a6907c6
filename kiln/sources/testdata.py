"""Bronze (all-text) ride-hailing tables derived from the benchmark parquet tables.

The mapping follows the project fixtures: users <- customer, captains <- supplier,
rides <- orders + per-order lineitem summary, payments <- lineitem, feedback <- events.
Every source row is kept; deterministic key arithmetic injects the dirt the cleaners
must handle (null and blank keys, four date layouts plus unparseable text, orphan ids,
malformed numbers, missing text, and a second copy of some rows). ``_seq`` is an
explicit landing order, so keep-first never depends on engine row order.

The same text is produced by the DuckDB oracle in ``kiln.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Landing order offset of the second copies, and orphan id offset.
COPY_OFFSET = 10 ** 12
ORPHAN_OFFSET = 10_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _null_or_blank(k: Column, value: Column, blank: str = "  ") -> Column:
    return F.when(k % 97 == 0, F.lit(None).cast("string")) \
        .when(k % 89 == 0, F.lit(blank)).otherwise(value)


def _date_text(k: Column, d: Column, fourth: str, users: bool) -> Column:
    bad_alt = F.lit("31/02/1995") if users else F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd"), F.lit(" "))
    return (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k % 5 == 1, F.date_format(d, "dd/MM/yyyy"))
            .when(k % 5 == 2, F.date_format(d, "dd.MM.yyyy"))
            .when(k % 5 == 3, F.date_format(d, fourth))
            .when(k % 3 == 0, F.lit("bad"))
            .when(k % 3 == 1, bad_alt))


def _with_copies(base: DataFrame, changes: dict[str, Column]) -> DataFrame:
    # both copies come out of one pass over the source tables
    copy = F.col("_copy")
    out = base.withColumn("_copy", F.explode(
        F.when(F.col("_seq") % 53 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    for c, v in changes.items():
        out = out.withColumn(c, F.when(copy, v).otherwise(F.col(c)))
    return out.withColumn("_seq", F.col("_seq") + F.when(copy, F.lit(COPY_OFFSET)).otherwise(F.lit(0))).drop("_copy")


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (k % 300).cast("int"))
    base = c.select(
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("gender"),
        _s(F.lit(18) + k % 60).alias("age"),
        _date_text(k, signup, "MM/dd/yyyy", users=True).alias("signup_date"),
        _s("c_nationkey").alias("city"),
        k.alias("_seq"),
        signup.alias("_signup_true"))
    out = _with_copies(base, {"name": F.concat(F.col("name"), F.lit(" (copy)")),
                              "signup_date": F.date_format(F.col("_signup_true"), "yyyy-MM-dd")})
    return out.drop("_signup_true")


def bronze_captains(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    rating = (k % 51).cast("decimal(4,0)") * F.lit(0.1).cast("decimal(2,1)")
    base = s.select(
        _null_or_blank(k, _s(k)).alias("captain_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 17 == 0, F.lit("   ")).otherwise(F.col("s_name")).alias("name"),
        F.when(k % 41 == 0, F.lit("abc")).when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(_s(F.lit(20) + k % 40)).alias("age"),
        _s(k % 30).alias("experience_years"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .when(k % 23 == 0, F.concat(F.lit("  "), _s("s_nationkey"), F.lit(" ")))
         .otherwise(_s("s_nationkey")).alias("city"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(_s(rating)).alias("rating"),
        k.alias("_seq"))
    return _with_copies(base, {"name": F.concat(F.coalesce(F.col("name"), F.lit("")), F.lit(" (copy)"))})


def bronze_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    li = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.min("l_suppkey").alias("_cap"), F.sum("l_linenumber").alias("_dur")))
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    status = (F.when(k % 31 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderstatus") == "F", F.lit("completed"))
              .when(F.col("o_orderstatus") == "P", F.lit("cancelled"))
              .when(F.col("o_orderstatus") == "O", F.lit("ongoing")))
    distance = F.col("o_totalprice").cast("decimal(12,2)") * F.lit(0.0001).cast("decimal(5,4)")
    base = j.select(
        _null_or_blank(k, _s(k)).alias("ride_id"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
         .when(k % 71 == 0, _s(F.col("o_custkey") + F.lit(ORPHAN_OFFSET)))
         .otherwise(_s("o_custkey")).alias("user_id"),
        F.when(k % 73 == 0, _s(F.col("_cap") + F.lit(ORPHAN_OFFSET)))
         .otherwise(_s("_cap")).alias("captain_id"),
        _date_text(k, d, "MM-dd-yyyy", users=False).alias("ride_date"),
        F.when(k % 29 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("pickup_loc"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("zone-"), _s(F.col("o_custkey") % 25))).alias("drop_loc"),
        F.when(k % 41 == 0, F.lit("abc")).otherwise(_s(distance)).alias("distance_km"),
        F.when(k % 43 == 0, F.lit(None).cast("string")).otherwise(_s("_dur")).alias("duration_min"),
        status.alias("ride_status"),
        k.alias("_seq"),
        d.alias("_date_true"))
    out = _with_copies(base, {"ride_date": F.date_format(F.col("_date_true"), "yyyy-MM-dd"),
                              "ride_status": F.lit("completed")})
    return out.drop("_date_true")


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    h = k + ln
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return li.select(
        F.concat(_s(k), F.lit("-"), _s(ln)).alias("payment_id"),
        F.when(h % 101 == 0, F.lit(None).cast("string")).when(h % 103 == 0, F.lit(" "))
         .otherwise(_s(k)).alias("ride_id"),
        F.col("l_returnflag").alias("payment_method"),
        F.when(h % 41 == 0, F.lit("abc")).otherwise(_s(price)).alias("fare"),
        F.when(h % 43 == 0, F.lit(None).cast("string")).otherwise(_s(disc * F.lit(100))).alias("discount_percent"),
        F.when(h % 47 == 0, F.lit("12d")).otherwise(_s(price * disc)).alias("discount_amount"),
        _s(price * (F.lit(1) - disc)).alias("final_amount"),
        F.col("l_linestatus").alias("payment_status"),
        (k * 16 + ln).alias("_seq"))


def bronze_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        _null_or_blank(k, _s(k), " ").alias("feedback_id"),
        F.when(k % 79 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("ride_id"),
        F.when(k % 41 == 0, F.lit("abc")).otherwise(_s(k % 6)).alias("user_rating"),
        F.when(k % 43 == 0, F.lit(None).cast("string"))
         .otherwise(_s((k + F.col("user_id")) % 6)).alias("captain_rating"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("event_type")).alias("issue_category"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("comments"),
        k.alias("_seq"))


BRONZE_BUILDERS = {
    "users": bronze_users, "captains": bronze_captains, "rides": bronze_rides,
    "payments": bronze_payments, "feedback": bronze_feedback,
}


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five bronze tables (lazy)."""
    return {n: b(spark, sf_dir) for n, b in BRONZE_BUILDERS.items()}
