"""Connected components of a link table, by alternating large and small stars.

Every round points the neighbours of each node at the smallest node they know. Rounds are
staged, so a lost executor repeats one round's tasks; minima are aggregated map-side and
staged before they are joined back, so a hub with most of all links is a plain join that
adaptive execution can split. Nothing but two scalars per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.store import Stage


def _star(stage: Stage, edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` holds (u, v) with u > v; so does the result."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        if large else edges
    least = stage.put(both.groupBy("u").agg(F.min("v").alias("m"))
                      .withColumn("m", F.least("m", "u")), "least")
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                  F.struct(F.col("u"), F.col("m").alias("v"))))
        out = joined.select(pairs.alias("e")).select("e.u", "e.v").filter("u <> v")
    result = stage.put(out.distinct(), "star")
    stage.drop(least)
    return result


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                           F.max("u")).first())


def components(stage: Stage, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; root is the component's smallest node.

    Links are pairs of longs in any order; self-links and repeats are allowed, rows with a
    null are ignored. An empty table gives an empty result."""
    edges = stage.put(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        big = _star(stage, edges, large=True)
        stage.drop(edges)
        edges = _star(stage, big, large=False)
        stage.drop(big)
        now = _print(edges)
        if now == seen:
            break
        seen = now
    # all that is left are stars: every node points at its root
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stage.put(edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                     .unionByName(roots), "components")
