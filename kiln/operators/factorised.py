"""Rows of a join by their rank, without making the join.

A join of two sides on a key has, for every left row, as many rows as the right side has of
its key. Kept apart, as left rows with these numbers and right rows with their places, the
relation stays as small as its two sides whatever the join's size; prefix sums of the numbers
say which left rows a range of ranks falls on, and only these are expanded.

``ranked`` gives every row the sum of weights before it in a total order: the rows are range
partitioned and sorted, summed within each partition, and shifted by the totals of the
partitions before (one number a partition reaches the driver). A key that holds most rows
spreads over partitions, as the order goes on to further columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PART = "_part"


def ranked(df: DataFrame, order: list[Column], weight: Column, alias: str,
           stage: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    """``df`` with ``alias``, the sum of ``weight`` over all rows before, and the sum of all.

    ``order`` should tell all rows apart that are not alike; rows that are may change places."""
    spread = stage(df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
                   .withColumn("_weight", weight))
    totals = sorted((r[_PART], r["n"]) for r in
                    spread.groupBy(_PART).agg(F.sum("_weight").alias("n")).collect())
    starts = list(accumulate([n for _, n in totals], initial=0))
    shift = df.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(totals, starts)], f"{_PART} int, _shift long")
    before = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition: a side of known size
    return (spread.join(F.broadcast(shift), _PART)
            .withColumn(alias, F.col("_shift") + F.coalesce(F.sum("_weight").over(before), F.lit(0)))
            .drop(_PART, "_weight", "_shift")), starts[-1]


@dataclass
class Factorised:
    """``left LEFT JOIN right`` on ``key``, each left row once with nulls if it has no partner.

    ``left`` has ``_first``, the rank of a row's first result, and ``_copies``; ``right`` has
    ``_place``; ``directory`` has each key's ``_start`` in the right order and ``_copies``."""
    left: DataFrame
    right: DataFrame
    key: str
    size: int
    right_columns: list[str]

    def page(self, start: int, stop: int) -> DataFrame:
        """Results of rank ``start`` to ``stop`` (exclusive), with ``row_no``."""
        hit = self.left.where(F.lit(start < stop) & (F.col("_first") < stop) & (F.col("_first") + F.col("_copies") > start))
        row = F.explode(F.sequence(F.greatest(F.lit(start), "_first"),
                                   F.least(F.lit(stop), F.col("_first") + F.col("_copies")) - 1))
        # at most stop - start rows; the right row is found by its place, whatever the key holds
        wanted = (hit.withColumn("row_no", row)
                  .withColumn("_at", F.col("_start") + F.col("row_no") - F.col("_first")))
        right = self.right.select(F.col("_place"), *self.right_columns)
        return wanted.join(right, wanted["_at"] == right["_place"], "left").drop(
            "_first", "_copies", "_start", "_at", "_place")


def factorise(left: DataFrame, right: DataFrame, key: str, left_order: list[Column],
              right_order: list[Column], stage: Callable[[DataFrame], DataFrame]) -> Factorised:
    """Prepare ``left LEFT JOIN right USING (key)`` for paging, in ``left_order``, then
    ``right_order``. ``right_order`` must begin with the key; null keys join nothing."""
    columns = [c for c in right.columns if c != key]
    placed, _ = ranked(right.where(F.col(key).isNotNull()), right_order, F.lit(1), "_place", stage)
    placed = stage(placed)
    directory = placed.groupBy(key).agg(F.min("_place").alias("_start"), F.count("*").alias("_n"))
    counted = left.join(directory, key, "left").withColumn("_copies", F.coalesce("_n", F.lit(1))).drop("_n")
    first, size = ranked(counted, left_order, F.col("_copies"), "_first", stage)
    return Factorised(stage(first), placed, key, size, columns)
