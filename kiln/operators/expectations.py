"""Declared silver constraints checked as distributed aggregates.

Row-local checks (not null, range, length) fold into one aggregate pass; uniqueness is
a partially aggregated count per key; a foreign key is an anti join. The result is a
small frame of (table_name, check_name, column_name, violations); ``enforce`` fails the
load like a database constraint would, and ``quarantine`` takes violators out of their tables,
with every row that depended on them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.schemas import Check


class ExpectationError(Exception):
    pass


def _row_violation(chk: Check) -> Column:
    c = F.col(chk.column)
    if chk.kind == "not_null":
        return c.isNull()
    if chk.kind == "range":
        bad = F.lit(False)
        if chk.low is not None:
            bad = bad | ((c < F.lit(chk.low)) if chk.low_inclusive else (c <= F.lit(chk.low)))
        if chk.high is not None:
            bad = bad | (c > F.lit(chk.high))
        return c.isNotNull() & bad
    if chk.kind == "max_len":
        return c.isNotNull() & (F.length(c) > F.lit(chk.max_len))
    raise ValueError(chk.kind)


def _row(table: str, chk: Check, n: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(chk.name).alias("check_name"),
            F.lit(chk.column).alias("column_name"), n.cast("bigint").alias("violations")]


def violations(df: DataFrame, table: str, checks: list[Check],
               refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Count violating rows per declared check."""
    refs = refs or {}
    parts: list[DataFrame] = []
    local = [c for c in checks if c.kind in ("not_null", "range", "max_len")]
    if local:
        agg = df.agg(*[F.count_if(_row_violation(c)).alias(f"v{i}") for i, c in enumerate(local)])
        stack = ", ".join(f"{i}, v{i}" for i in range(len(local)))
        longf = agg.selectExpr(f"stack({len(local)}, {stack}) AS (idx, n)")
        names = F.array(*[F.struct(F.lit(c.name).alias("k"), F.lit(c.column).alias("c"))
                          for c in local])
        parts.append(longf.select(
            F.lit(table).alias("table_name"), names[F.col("idx")]["k"].alias("check_name"),
            names[F.col("idx")]["c"].alias("column_name"), F.col("n").cast("bigint").alias("violations")))
    for chk in checks:
        if chk.kind == "unique":
            dup_rows = (df.where(F.col(chk.column).isNotNull()).groupBy(chk.column)
                        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
            parts.append(dup_rows.select(*_row(table, chk, F.col("n"))))
        elif chk.kind == "foreign_key":
            ref = refs.get(chk.ref_table)
            if ref is None:
                continue
            keys = ref.select(F.col(chk.ref_column).alias("_ref")).distinct()
            orphans = (df.where(F.col(chk.column).isNotNull())
                       .join(keys, F.col(chk.column) == F.col("_ref"), "left_anti")
                       .agg(F.count(F.lit(1)).alias("n")))
            parts.append(orphans.select(*_row(table, chk, F.col("n"))))
    return reduce(DataFrame.unionByName, parts)


def enforce(df: DataFrame, table: str, checks: list[Check],
            refs: dict[str, DataFrame] | None = None) -> None:
    """Fail when any check is violated (one small job; only counts reach the driver)."""
    bad = violations(df, table, checks, refs).where(F.col("violations") > 0).collect()
    if bad:
        msg = ", ".join(f"{r.check_name}({r.column_name})={r.violations}" for r in bad)
        raise ExpectationError(f"{table}: {msg}")


@dataclass
class Quarantine:
    """``kept``: each table without its violators. ``rejected``: the violators with all cells
    as text, ``reason`` and ``depth`` (0: the row's own fault; n: a row it refers to, at the
    end of n references, was taken out)."""
    kept: dict[str, DataFrame]
    rejected: dict[str, DataFrame]


def load_order(checks: dict[str, list[Check]]) -> list[str]:
    """Tables so that every one follows those it refers to; a cycle raises."""
    graph = {t: {c.ref_table for c in cs if c.kind == "foreign_key" and c.ref_table in checks}
             for t, cs in checks.items()}
    return list(TopologicalSorter(graph).static_order())


def reason_of(chk: Check) -> str:
    return f"constraint {chk.name} on {chk.column}"


_VERDICT, _GONE, _TIE = "_kiln_verdict", "_kiln_gone", "_kiln_tie"


def quarantine(tables: dict[str, DataFrame], checks: dict[str, list[Check]],
               stage: Callable[[DataFrame], DataFrame]) -> Quarantine:
    """Take violators out of ``tables``, and what refers to them, until every check holds.

    Tables are treated along the foreign-key graph, parents first, against the parents' rows
    that stay: that is the fixpoint, and a dropped ride drops its payments. A row has the first
    check it fails, in the order not null, range, length (as declared), foreign key, unique. Of
    rows that pass all others and share a key the least by all columns stays, one of exact
    copies. Null cells pass all checks but not null. Checks on tables that are not given are
    left out. Every table is staged once, labelled; keys are joined, never collected.
    """
    order = [t for t in load_order(checks) if t in tables]
    kept: dict[str, DataFrame] = {}
    rejected: dict[str, DataFrame] = {}
    labelled: dict[str, DataFrame] = {}

    def parent_keys(chk: Check) -> DataFrame:
        # null depth: at least one row of the key stays
        rows = labelled[chk.ref_table].where(F.col(chk.ref_column).isNotNull())
        stays = F.max(F.col(_VERDICT).isNull())
        return rows.groupBy(F.col(chk.ref_column).alias("_kiln_ref")).agg(
            F.when(~stays, F.min(f"{_VERDICT}.depth")).alias(_GONE), F.lit(True).alias("_kiln_hit"))

    for name in order:
        columns = tables[name].columns
        rank = {"foreign_key": 1, "unique": 2}
        chks = sorted(checks[name], key=lambda c: rank.get(c.kind, 0))
        df = tables[name].withColumn(_VERDICT, F.lit(None).cast("struct<reason:string,depth:long>"))

        def fail(df: DataFrame, bad: Column, chk: Check, depth: Column) -> DataFrame:
            return df.withColumn(_VERDICT, F.coalesce(_VERDICT, F.when(bad, F.struct(
                F.lit(reason_of(chk)).alias("reason"), depth.cast("long").alias("depth")))))
        for chk in chks:
            if chk.kind in ("not_null", "range", "max_len"):
                df = fail(df, _row_violation(chk), chk, F.lit(0))
            elif chk.kind == "foreign_key" and chk.ref_table in labelled:
                df = df.join(parent_keys(chk), F.col(chk.column) == F.col("_kiln_ref"), "left")
                bad = F.col(chk.column).isNotNull() & (F.col("_kiln_hit").isNull() | F.col(_GONE).isNotNull())
                df = fail(df, bad, chk, F.coalesce(F.col(_GONE) + 1, F.lit(0))) \
                    .drop("_kiln_ref", "_kiln_hit", _GONE)
        unique = [c for c in chks if c.kind == "unique"]
        if unique:
            df = stage(df)
        for chk in unique:
            # only keys with several live rows are looked at; their least row is found by a
            # partial minimum and joined back by its number, so no task holds a hot key
            numbered = df.withColumn(_TIE, F.monotonically_increasing_id())
            live = numbered.where(F.col(_VERDICT).isNull() & F.col(chk.column).isNotNull())
            repeated = live.groupBy(F.col(chk.column).alias("_kiln_ref")).agg(
                F.min(F.struct(*columns, _TIE)).alias("least"), F.count("*").alias("n")) \
                .where("n > 1").select("_kiln_ref", F.col(f"least.{_TIE}").alias("_kiln_first"))
            df = numbered.join(repeated, F.col(chk.column) == F.col("_kiln_ref"), "left")
            df = fail(df, F.col("_kiln_first") != F.col(_TIE), chk, F.lit(0)) \
                .drop("_kiln_ref", "_kiln_first", _TIE)
        labelled[name] = stage(df)
        kept[name] = labelled[name].where(F.col(_VERDICT).isNull()).select(*columns)
        rejected[name] = labelled[name].where(F.col(_VERDICT).isNotNull()).select(
            *[F.col(c).cast("string").alias(c) for c in columns],
            F.col(f"{_VERDICT}.reason").alias("reason"), F.col(f"{_VERDICT}.depth").alias("depth"))
    return Quarantine(kept, rejected)
