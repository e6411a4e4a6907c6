"""Assignment into a declared typed layout, and the audit of cells that cannot be assigned.

A cell that holds text which is no number, or a number its column cannot hold, becomes null in
the typed table; ``with_cells`` says so, as an array that travels with the row through a
cleaning job and is exploded into one audit row a cell (``explode_cells``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.exprs import NUMBER_PATTERN, strip_ws, to_int_half_even, to_number
from kiln.schemas import TableSpec

CELLS = "_cells"
MALFORMED, OVERFLOW = "malformed", "overflow"


def assign(col, target: T.DataType) -> Column:
    """Cast the way a typed table assignment does: fractions into INT round half-even,
    numbers into DECIMAL round half-up at the declared scale; what does not fit is null."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(target, T.IntegerType):
        return to_int_half_even(c.cast("double"))
    return c.try_cast(target)


def plain_number(column: str, target: T.DataType) -> Column:
    """True for digits, with or without a fraction, that the target type holds for certain: the
    one test that nearly all cells need. What it does not know, it says is not plain."""
    digits = "[0-9]{1,9}" if isinstance(target, T.IntegerType) else None
    if isinstance(target, T.DecimalType) and target.precision <= 15:
        whole = target.precision - target.scale
        # digits beyond the scale may round up to one more whole digit; up to 15 digits are the same
        # number as text and as a double
        forms = ([f"[0-9]{{1,{whole}}}(?:\\.[0-9]{{0,{target.scale}}})?"] if whole > 0 else []) + \
            ([f"[0-9]{{1,{whole - 1}}}\\.[0-9]{{1,{16 - whole}}}"] if whole > 1 else [])
        digits = "|".join(forms) or None
    return F.col(column).rlike(f"^(?:{digits})\\z") if digits else F.lit(False)


def number_for(column: str, target: T.DataType) -> Column:
    """The number in a text cell, null unless the target type can hold it."""
    v = to_number(column)
    return F.when(plain_number(column, target), F.col(column).try_cast("double")) \
        .when(assign(v, target).isNotNull(), v)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project ``df`` onto the silver layout of ``spec``: missing columns and cells that do
    not fit become null."""
    out = []
    for name, typ in spec.silver_types:
        if name not in df.columns:
            out.append(F.lit(None).cast(typ).alias(name))
            continue
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        if is_text and isinstance(typ, T.NumericType):
            out.append(assign(to_number(name), typ).alias(name))
        else:
            out.append(assign(name, typ).alias(name))
    return df.select(*out)


def with_cells(df: DataFrame, spec: TableSpec, skip: tuple[str, ...] = (), numbers: dict[str, str] | None = None,
               assigned: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``_cells``, an array of ``column_name, raw_text, target_type, problem`` for the
    number cells of a raw row that cannot be assigned; blank cells are missing, not wrong.

    ``numbers`` and ``assigned`` (column -> new column) ask for the cells that can be, as
    doubles (``number_for``) and as the silver column has them (``assign`` of that).

    Plain numbers, which are right, are cast as they are; what a cell is that is not plain,
    ``_judged`` says, in a column of its own that is null for plain ones."""
    cells = [(c, t) for c, t in spec.silver_types if isinstance(t, T.NumericType) and c not in skip]
    if not cells:
        return df.withColumn(CELLS, F.array().cast(
            "array<struct<column_name:string,raw_text:string,target_type:string,problem:string>>"))
    odd, target = {c: f"_odd_{c}" for c, _ in cells}, dict(cells)
    out = df.withColumns({odd[c]: F.when(~plain_number(c, t), _judged(c, t)) for c, t in cells})

    def right(c: str, t: T.DataType) -> Column:
        direct = assign(F.col(c).try_cast("double"), t) if isinstance(t, T.IntegerType) else F.col(c).try_cast(t)
        return F.when(F.col(odd[c]).isNull(), direct).otherwise(
            F.col(f"{odd[c]}.{'num' if isinstance(t, T.DoubleType) else 'assigned'}"))
    out = out.withColumns({a: right(c, T.DoubleType()) for c, a in (numbers or {}).items()} |
                          {a: right(c, target[c]) for c, a in (assigned or {}).items()})
    found = F.array_compact(F.array(*[F.when(F.col(f"{odd[c]}.problem").isNotNull(), F.struct(
        F.lit(c).alias("column_name"), F.col(c).alias("raw_text"), F.lit(t.simpleString()).alias("target_type"),
        F.col(f"{odd[c]}.problem").alias("problem"))) for c, t in cells]))
    # most rows have no text left to judge and get the constant
    return out.withColumn(CELLS, F.when(F.coalesce(*[F.col(f"{odd[c]}.odd") for c, _ in cells]).isNull(), F.array().cast(
        out.select(found.alias("found")).schema["found"].dataType)).otherwise(found)).drop(*odd.values())


def _judged(column: str, target: T.DataType) -> Column:
    """``odd`` (true), ``num``, ``assigned``: the number and what the typed column has of it, null
    unless it can be assigned, and the ``problem``, null for blank text.

    Steps are lambdas: each is worked out once, and only for the few cells asked about; as generated
    code the regexes and casts of a table's columns make one method too large for the JIT compiler."""
    numbers = F.transform(F.transform(F.array(F.col(column)), strip_ws), lambda text: F.struct(
        text.alias("text"), F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")).alias("num")))
    fits = F.transform(numbers, lambda n: F.struct(
        n["text"].alias("text"), n["num"].alias("num"),
        F.when(F.abs(n["num"]) < F.lit(float("inf")), assign(n["num"], target)).alias("assigned")))
    return F.transform(fits, lambda n: F.struct(
        F.lit(True).alias("odd"), F.when(n["assigned"].isNotNull(), n["num"]).alias("num"),
        n["assigned"].alias("assigned"),
        F.when(n["text"] == "", F.lit(None).cast("string")).when(n["num"].isNull(), MALFORMED)
        .when(n["assigned"].isNull(), OVERFLOW).alias("problem")))[0]


def explode_cells(rows: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """One row for each audited cell: ``row_key``, the error, ``run_ts``."""
    return (rows.where(F.size(CELLS) > 0)
            .select(F.col(key).cast("string").alias("row_key"), F.explode(CELLS).alias("e"))
            .select("row_key", "e.*", F.lit(run_ts).cast("timestamp").alias("run_ts")))
