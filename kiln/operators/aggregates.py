"""Aggregates that stay partial (map-side combined) at any key skew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distributed exact median: cells of the split grid, sketch accuracy, and the number of values
# that one task may hold of a column.
MEDIAN_GRID = 1000
MEDIAN_ACCURACY = 10000
MEDIAN_FINAL_ROWS = 10_000


def mode_by(df: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    """Most frequent non-null ``value`` per ``keys``; ties go to the smallest value.

    Two aggregations instead of one map-per-group: counts per (keys, value) first, then
    the minimum of (-count, value) per key. Both steps combine map-side, so neither a hot
    key nor free-text values make one task hold a whole group. Groups whose values are
    all null produce no row (a left join back gives null, like MODE() does).
    """
    alias = alias or value
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    best = F.min(F.struct((-F.col("_n")).alias("neg_n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col("_best.v").alias(alias))


def modes_by(df: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """``mode_by`` of several text columns at once (``values``: column -> alias): the columns
    become rows, so ``df`` is read and shuffled once. Keys whose cells are all null have no row."""
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("k"), F.col(c).cast("string").alias("v"))
                                for c, a in values.items()]))
    counts = (df.select(key, cells.alias("_c")).where("_c.v IS NOT NULL")
              .groupBy(key, "_c").agg(F.count(F.lit(1)).alias("_n")))
    best = {a: F.min(F.when(F.col("_c.k") == a, F.struct((-F.col("_n")).alias("n"), F.col("_c.v").alias("v"))))
            for a in values.values()}
    return counts.groupBy(key).agg(*[b["v"].alias(a) for a, b in best.items()])


def mode_of(df: DataFrame, value: str) -> Column:
    """Global mode as a scalar subquery (evaluated once, no join back to the rows)."""
    return mode_by(df, [], value, "_mode").scalar()


@dataclass
class _Rank:
    """Search for the value of one rank of one column: it lies strictly between ``low`` and
    ``high`` (None: open), ``below`` values are at most ``low`` and ``inside`` between them."""
    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def band(self) -> tuple:
        return self.column, self.low, self.high

    def narrow(self, split: float, less: int, at_most: int) -> None:
        if less <= self.rank < at_most:
            self.found = split
        elif at_most <= self.rank and (self.low is None or split > self.low):
            self.low, self.inside = split, self.inside - (at_most - self.below)
            self.below = at_most
        elif less > self.rank and (self.high is None or split < self.high):
            self.high, self.inside = split, less - self.below


def _within(v: Column, low: float | None, high: float | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (v > F.lit(low))
    if high is not None:
        inside = inside & (v < F.lit(high))
    return F.when(inside, v)


def exact_medians(df: DataFrame, values: dict[str, Column]) -> dict[str, float | None]:
    """Exact interpolated medians (Spark ``median`` semantics) of many columns at once.

    A distributed selection. One job takes a bounded sketch of every open band of every
    column; the next counts, for the few grid values around each wanted rank, how many values
    are less and how many at most that: either a grid value has the rank, or the counts say
    between which two it lies. Counts are exact, so a sketch that is off costs a round, never a
    result, and a value that fills many cells is met as a grid value. Once a band has at most
    ``MEDIAN_FINAL_ROWS`` values, one aggregate reads the rank from them. The number of jobs
    depends neither on the number of columns nor on ties; what reaches the driver is a grid
    for each band. Null and NaN cells are not counted; no other cell gives None.
    """
    cells = df.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(n)
                        for n, c in values.items()])
    fractions = [j / MEDIAN_GRID for j in range(MEDIAN_GRID + 1)]

    def sketch(column, low, high):
        return F.percentile_approx(_within(F.col(f"`{column}`"), low, high), fractions,
                                   MEDIAN_ACCURACY)
    if not values:
        return {}
    first = cells.agg(*[F.count(f"`{n}`") for n in values]).first()
    grids: dict[tuple, list[float]] = {}  # sketches, taken only of bands that are too wide to read
    ranks = [_Rank(n, k, first[i]) for i, n in enumerate(values) if first[i]
             for k in sorted({(first[i] - 1) // 2, first[i] // 2})]
    while True:
        wide = [r for r in ranks if r.found is None and r.inside > MEDIAN_FINAL_ROWS]
        if not wide:
            break
        missing = sorted({r.band() for r in wide} - set(grids), key=str)
        if missing:
            row = cells.agg(*[sketch(*b).alias(f"b{i}") for i, b in enumerate(missing)]).first()
            grids.update(zip(missing, row))
        probes = sorted({(r.column, s) for r in wide for s in _near(grids[r.band()], r)})
        row = cells.agg(*[F.count_if(F.col(f"`{n}`") < F.lit(s)).alias(f"l{i}")
                          for i, (n, s) in enumerate(probes)],
                        *[F.count_if(F.col(f"`{n}`") <= F.lit(s)).alias(f"m{i}")
                          for i, (n, s) in enumerate(probes)]).first()
        for r in wide:
            for i, (n, s) in enumerate(probes):
                if n == r.column and r.found is None:
                    r.narrow(s, row[i], row[len(probes) + i])
    open_bands = sorted({r.band() for r in ranks if r.found is None}, key=str)
    if open_bands:
        row = cells.agg(*[F.sort_array(F.collect_list(_within(F.col(f"`{n}`"), low, high)))
                          for n, low, high in open_bands]).first()
        read = dict(zip(open_bands, row))
        for r in ranks:
            if r.found is None:
                r.found = read[r.band()][r.rank - r.below]
    out: dict[str, float | None] = {}
    for n in values:
        pair = [float(r.found) for r in ranks if r.column == n]
        out[n] = None if not pair else pair[0] if pair[0] == pair[-1] \
            else 0.5 * pair[0] + 0.5 * pair[-1]
    return out


def _near(grid: list[float], r: _Rank) -> list[float]:
    """Grid values around the place where the wanted rank should be."""
    i = (r.rank - r.below) * MEDIAN_GRID // r.inside
    return sorted(set(grid[max(i - 1, 0):i + 3]))


def exact_median(df: DataFrame, value: str | Column) -> float | None:
    """``exact_medians`` of one column."""
    c = F.col(value) if isinstance(value, str) else value
    return exact_medians(df, {"v": c})["v"]


def medians_of(df: DataFrame, *columns: str) -> list[Column]:
    """Exact medians of ``columns`` over ``df`` as literals for use in expressions."""
    found = exact_medians(df, {c: F.col(c) for c in columns})
    return [F.lit(found[c]).cast("double") for c in columns]


def avg_nonzero(c) -> Column:
    """AVG(NULLIF(x, 0)) in double precision: zero means 'not rated'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.avg(F.nullif(c, F.lit(0)).cast("double"))
