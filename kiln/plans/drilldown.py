"""Where two sides of a reconciliation differ: a hash-bucket tree over their keys.

Both sides are tables of keys with measures. A node of the tree is a bucket of key hashes with
the number of keys, the sum of each measure and a checksum of all its rows, so that differences
that cancel out are seen too. The top level has ``1 << bits`` buckets for each side, and only
those that differ are opened: their rows alone are summed in buckets ``1 << bits`` times as
fine, and only rows of fine buckets that still differ are compared key by key. Everything is
summed map-side; a level's nodes are at most the level's buckets, whatever the tables' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURE = "decimal(38,6)"


def _bucket(level: int, bits: int) -> Column:
    """The bucket of a key at a level; level 0 is the coarsest."""
    return F.shiftrightunsigned(F.col("_hash"), 64 - bits * (level + 1))


def _side(df: DataFrame, key: str, measures: list[str]) -> DataFrame:
    rows = df.groupBy(F.col(key).alias("key")).agg(
        F.count("*").alias("_rows"), *[F.sum(F.col(m).cast(MEASURE)).alias(m) for m in measures])
    state = F.xxhash64("key", "_rows", *[F.col(m) for m in measures])
    return rows.withColumn("_hash", F.xxhash64("key")).withColumn("_state", state)


def _nodes(side: DataFrame, level: int, bits: int) -> DataFrame:
    return side.groupBy(_bucket(level, bits).alias("bucket")).agg(
        F.count("*").alias("keys"), F.bit_xor("_state").alias("check"),
        F.sum(F.col("_state").cast("decimal(38,0)")).alias("total"))


def differing_buckets(left: DataFrame, right: DataFrame, level: int, bits: int) -> DataFrame:
    """Buckets of a level whose nodes are not the same on both sides."""
    a, b = _nodes(left, level, bits), _nodes(right, level, bits)
    same = (a["keys"].eqNullSafe(b["keys"]) & a["check"].eqNullSafe(b["check"])
            & a["total"].eqNullSafe(b["total"]))
    return a.join(b, "bucket", "full").where(~same).select("bucket")


def drill_down(left: DataFrame, right: DataFrame, key: str, measures: list[str], stage,
               bits: int = 12, levels: int = 2) -> DataFrame:
    """``row_key, measure, left_value, right_value, difference`` of every key and measure that
    differ, ``rows`` among the measures; ``difference`` is null where a side lacks the key or
    the value.

    Rows of one key are added up first (an aggregate that is combined map-side); null keys are
    a key. Two nulls are the same, a null and a number are not. ``stage`` writes a side once,
    since every level reads it."""
    a, b = stage(_side(left, key, measures)), stage(_side(right, key, measures))
    for level in range(levels):
        open_ = differing_buckets(a, b, level, bits)
        # at most the level's buckets: a bounded side; AQE broadcasts it by its measured size
        a, b = (s.join(open_, _bucket(level, bits) == F.col("bucket"), "left_semi") for s in (a, b))
    x, y = a.alias("x"), b.alias("y")
    rows = x.join(y, F.col("x.key").eqNullSafe(F.col("y.key")), "full").where(
        ~F.col("x._state").eqNullSafe(F.col("y._state")))
    cells = F.explode(F.array(*[F.struct(
        F.lit(name).alias("measure"), F.col(f"x.{c}").cast(MEASURE).alias("left_value"),
        F.col(f"y.{c}").cast(MEASURE).alias("right_value")) for name, c in
        [("rows", "_rows"), *zip(measures, measures)]]))
    missing = F.col("x._hash").isNull() | F.col("y._hash").isNull()
    return (rows.select(F.coalesce("x.key", "y.key").alias("row_key"), missing.alias("missing"),
                        cells.alias("c"))
            .where("missing OR NOT (c.left_value <=> c.right_value)")
            .select("row_key", "c.*", (F.col("c.left_value") - F.col("c.right_value")).alias("difference")))
