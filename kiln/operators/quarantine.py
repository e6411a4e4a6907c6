"""Ordered reject rules over one labelled frame.

A labelled frame is the input plus a ``reason`` column: null while the row is alive,
otherwise the first rule it failed. Every step only labels rows, so the whole chain is
one lazy plan; ``split`` then yields the clean rows and the audited rejects as two
filters of the same frame. No id set ever reaches the driver: membership checks are
joins, duplicate ranking is an aggregate plus a join on a unique row number.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.conform import CELLS, explode_cells

REASON = "reason"
RUN_TS = "run_ts"
DROP = "_silent_drop"
SEQ = "_seq"

_ids = itertools.count()


@dataclass
class CleanResult:
    """Output of a cleaning job: typed survivors, the audited rejects, and the audited cells
    of the survivors that could not be assigned."""
    clean: DataFrame
    rejects: DataFrame
    cells: DataFrame | None = None


def start(df: DataFrame) -> DataFrame:
    """Begin a rule chain: every row alive."""
    return df.withColumn(REASON, F.lit(None).cast("string")).withColumn(DROP, F.lit(False))


def alive_cond() -> Column:
    return F.col(REASON).isNull() & ~F.col(DROP)


def alive(df: DataFrame) -> DataFrame:
    """Rows that passed every rule applied so far."""
    return df.where(alive_cond())


def reject_if(df: DataFrame, cond: Column, reason: str) -> DataFrame:
    """Label alive rows matching ``cond``; rows already labelled keep their first reason."""
    return df.withColumn(REASON, F.coalesce(F.col(REASON), F.when(cond & ~F.col(DROP), F.lit(reason))))


def reject_orphans(df: DataFrame, column: str, keys: DataFrame, key_column: str,
                   reason: str, many_keys: bool = False) -> DataFrame:
    """Label rows whose ``column`` value is absent from ``keys[key_column]``.

    A left join to the distinct key set; a null value never matches, so it counts as an
    orphan (unless an earlier rule already took the row). The planner sizes the join at
    run time: a small key side is broadcast, a large one is shuffled, and a hot value is
    split by the skew-join handling. With ``many_keys``, keys that grow with the rows, each
    partition's keys are hashed, so the rows, with all their text, are never sorted.
    """
    n = next(_ids)
    k, hit = f"_fk{n}_key", f"_fk{n}_hit"
    key_set = keys.select(F.col(key_column).alias(k)).distinct().withColumn(hit, F.lit(True))
    if many_keys:
        key_set = key_set.hint("shuffle_hash")
    joined = df.join(key_set, df[column] == key_set[k], "left")
    return reject_if(joined, F.col(hit).isNull(), reason).drop(k, hit)


def reject_duplicates(df: DataFrame, key: str, reason: str, order: str = SEQ,
                      audit: bool = True) -> DataFrame:
    """Keep the first alive row per ``key`` in ``order``; label (or silently drop) the rest.

    Only rows alive at this point compete, so an invalid first copy never shadows a valid
    later one. Keys are counted by a partially aggregated ``min`` per key; only keys with
    several live rows are joined back, on the key, so rows are shuffled only if there are too
    many such keys to broadcast (adaptive execution measures them), and a key that holds a third
    of all rows then lies on the side that skew handling splits. Of rows that share key and
    order exactly one stays. Null keys count as equal to each other. ``df`` is read twice and
    should be a table or a staged frame, whose rows are numbered alike.
    """
    n = next(_ids)
    tie, first, k = f"_dd{n}_row", f"_dd{n}_first", f"_dd{n}_key"
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    repeated = (alive(numbered).groupBy(F.col(key).alias(k))
                .agg(F.min(F.struct(order, tie)).alias("_f"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select(k, F.col(f"_f.{tie}").alias(first)))
    joined = numbered.join(repeated, numbered[key].eqNullSafe(repeated[k]), "left")
    dup = alive_cond() & F.col(first).isNotNull() & (F.col(first) != F.col(tie))
    if audit:
        out = reject_if(joined, dup, reason)
    else:
        out = joined.withColumn(DROP, F.col(DROP) | dup)
    return out.drop(tie, first, k)


def split(labelled: DataFrame, clean_cols: list, audit_cols: list[str],
          run_ts: datetime | None = None, key: str | None = None) -> CleanResult:
    """Turn a labelled frame into (clean, rejects, cells).

    Rejects carry the raw text of every audited column, the reason, and one run-level
    timestamp; a frame with cell errors and a ``key`` gives its survivors' cells as well.
    Silently dropped rows appear in no output.
    """
    run_ts = run_ts or datetime.now()
    ts = F.lit(run_ts).cast("timestamp")
    clean = labelled.where(alive_cond()).select(*clean_cols)
    rejects = (labelled.where(F.col(REASON).isNotNull())
               .select(*audit_cols, F.col(REASON), ts.alias(RUN_TS)))
    cells = (explode_cells(alive(labelled), key, run_ts)
             if key and CELLS in labelled.columns else None)
    return CleanResult(clean, rejects, cells)


def union_rejects(*frames: DataFrame) -> DataFrame:
    """Union reject sets by column name; columns missing on one side become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
