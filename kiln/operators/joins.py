"""Outer joins written so a hot key never pins one task.

Spark can split a skewed shuffle partition only on the side whose rows are preserved
as is (left of a LEFT join), and can broadcast only the other side. A "one" table left
joined to a "many" table (users to rides) has its hot keys on the wrong side for both.
These helpers express the same result as an inner join with the many side streamed
(broadcast the one side when the planner measures it small, split hot keys otherwise)
plus the unmatched rows found against the *distinct* keys of the many side (a partial
aggregate collapses hot keys before any shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_fill(df: DataFrame, like: DataFrame, keep: list[str]) -> DataFrame:
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields
             if f.name not in keep and f.name not in df.columns]
    return df.select(*df.columns, *extra)


def left_join_many(one: DataFrame, many: DataFrame, key: str,
                   keys: DataFrame | None = None) -> DataFrame:
    """``one LEFT JOIN many USING (key)`` with the columns of ``one`` first.

    Rows of ``one`` with a null key, or with no partner, appear once with nulls. ``keys`` is a
    cheaper table with the same keys as ``many``, read instead of it to find those rows.
    """
    matched = many.join(one, key, "inner").select(*one.columns,
                                                  *[c for c in many.columns if c != key])
    keys = (many if keys is None else keys).where(F.col(key).isNotNull()).select(key).distinct()
    unmatched = one.join(keys, key, "left_anti")
    unmatched = _null_fill(unmatched, many, [key])
    return matched.unionByName(unmatched)


def full_join_lookup(many: DataFrame, lookup: DataFrame, many_key: str,
                     lookup_key: str) -> DataFrame:
    """``many FULL OUTER JOIN lookup ON many_key = lookup_key`` for a lookup that is
    unique on its key: the many side is preserved (splittable, or the lookup broadcast),
    and lookup rows nobody references are appended with nulls for the many side."""
    matched = many.join(lookup, F.col(many_key) == F.col(lookup_key), "left")
    used = many.where(F.col(many_key).isNotNull()).select(F.col(many_key).alias("_used")).distinct()
    orphans = lookup.join(used, F.col(lookup_key) == F.col("_used"), "left_anti")
    orphans = _null_fill(orphans, many, [])
    return matched.unionByName(orphans.select(*matched.columns))
