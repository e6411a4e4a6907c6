"""Column expressions for cleaning text cells. All are built-in Spark expressions, so
they run inside whole-stage codegen with no Python worker."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, tried in order; the first that parses wins.
# Day and month take one or two digits; the year takes four.
USERS_DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "d.M.yyyy", "M/d/yyyy"]
RIDES_DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "d.M.yyyy", "M-d-yyyy"]

# Plain decimal or scientific number after trimming. Anything else ("12d", "0x10",
# "1,000", "abc", "nan", "inf") is not a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs and newlines too)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def is_blank(c) -> Column:
    """True for null or whitespace-only text."""
    c = _c(c)
    return c.isNull() | ~c.rlike(r"\S")


def blank_to_null(c) -> Column:
    """Empty text becomes null (whitespace-only text is kept)."""
    return F.nullif(_c(c), F.lit(""))


def fill_text(c, value: str, empty_is_missing: bool = True) -> Column:
    """Replace a missing cell by a constant; optionally count '' as missing."""
    c = _c(c)
    return F.coalesce(blank_to_null(c) if empty_is_missing else c, F.lit(value))


def looks_numeric(c) -> Column:
    """True for text that is a plain or scientific number after trimming."""
    return strip_ws(_c(c)).rlike(NUMBER_PATTERN)


def to_number(c) -> Column:
    """Tolerant text-to-double: malformed text, and text beyond any double (``1e999``),
    becomes null instead of failing."""
    v = strip_ws(_c(c)).try_cast("double")
    return F.when(looks_numeric(c) & (F.abs(v) < F.lit(float("inf"))), v)


def _date_in(c: Column, layout: str) -> Column:
    """``try_to_date``, asked only about text of the layout's shape.

    Plain text (a year of four digits, day and month of one or two) is put in the order of ISO
    dates and cast, which costs a tenth; the formatter reads what else could have the layout
    (signs, more digits). Layouts other than year, month and day with a separator go to it whole."""
    parts = re.fullmatch(r"(yyyy|M|d)([-/.])(yyyy|M|d)\2(yyyy|M|d)", layout)
    if not parts or len({*parts.group(1, 3, 4)}) < 3:
        return F.try_to_date(c, layout)
    fields, sep = parts.group(1, 3, 4), re.escape(parts.group(2))
    plain = "^" + sep.join("(?!0000)([0-9]{4})" if f == "yyyy" else "([0-9]{1,2})" for f in fields) + r"\z"
    shape = "^" + sep.join("[+-]?[0-9]{4,}" if f == "yyyy" else "[+-]?[0-9]+" for f in fields) + r"\z"
    iso = c if layout == "yyyy-M-d" else F.regexp_replace(
        c, plain, "-".join(f"${fields.index(f) + 1}" for f in ("yyyy", "M", "d")))
    return F.when(c.rlike(plain), iso.try_cast("date")).when(c.rlike(shape), F.try_to_date(c, layout))


def parse_date(c, formats: list[str], trim: bool = False) -> Column:
    """First layout in ``formats`` that parses the whole text; null if none does."""
    c = strip_ws(_c(c)) if trim else _c(c)
    return F.coalesce(*[_date_in(c, f) for f in formats])


def round_half_even(c, scale: int) -> Column:
    return F.bround(_c(c), scale)


def to_int_half_even(c) -> Column:
    """Assignment of a fractional number to an INT column (banker's rounding); null if it
    does not fit."""
    return F.bround(_c(c), 0).try_cast("int")


def truncate_int(c) -> Column:
    """Drop the fraction (toward zero); null if the rest does not fit."""
    return _c(c).try_cast("int")
