"""Declared table layouts for the four layers (bronze, silver, audit, gold).

Bronze is text only, exactly as landed. Silver carries the typed layout and the
constraints the silver layer promises (checked by ``kiln.operators.expectations``).
Audit mirrors the bronze text of a rejected row plus ``reason`` and ``run_ts``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()

# Entity names and their raw (bronze) columns, in landing order.
BRONZE_COLUMNS = {
    "users": ["user_id", "name", "gender", "age", "signup_date", "city"],
    "captains": ["captain_id", "name", "age", "experience_years", "city", "rating"],
    "rides": ["ride_id", "user_id", "captain_id", "ride_date", "pickup_loc", "drop_loc",
              "distance_km", "duration_min", "ride_status"],
    "payments": ["payment_id", "ride_id", "payment_method", "fare", "discount_percent",
                 "discount_amount", "final_amount", "payment_status"],
    "feedback": ["feedback_id", "ride_id", "user_rating", "captain_rating", "issue_category",
                 "comments"],
}


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# Silver column types.
SILVER_TYPES = {
    "users": [("user_id", S), ("name", S), ("gender", S), ("age", T.IntegerType()),
              ("signup_date", T.DateType()), ("city", S)],
    "captains": [("captain_id", S), ("name", S), ("age", T.IntegerType()),
                 ("experience_years", T.IntegerType()), ("city", S), ("rating", _dec(3, 2))],
    "rides": [("ride_id", S), ("user_id", S), ("captain_id", S), ("ride_date", T.DateType()),
              ("pickup_loc", S), ("drop_loc", S), ("distance_km", _dec(7, 2)),
              ("duration_min", T.IntegerType()), ("ride_status", S)],
    "payments": [("payment_id", S), ("ride_id", S), ("payment_method", S), ("fare", _dec(10, 2)),
                 ("discount_percent", _dec(5, 2)), ("discount_amount", _dec(10, 2)),
                 ("final_amount", _dec(10, 2)), ("payment_status", S)],
    "feedback": [("feedback_id", S), ("ride_id", S), ("user_rating", _dec(2, 1)),
                 ("captain_rating", _dec(2, 1)), ("issue_category", S), ("comments", S)],
}


@dataclass(frozen=True)
class Check:
    """One declared constraint on a silver column."""
    kind: str                    # not_null | unique | range | max_len | foreign_key
    column: str
    low: float | None = None
    high: float | None = None
    low_inclusive: bool = True
    max_len: int | None = None
    ref_table: str | None = None
    ref_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "range":
            lo = "" if self.low is None else ("[" if self.low_inclusive else "(") + f"{self.low:g}"
            hi = "" if self.high is None else f"{self.high:g}]"
            return f"range{lo},{hi}".replace("range,", "range")
        if self.kind == "max_len":
            return f"max_len{self.max_len}"
        if self.kind == "foreign_key":
            return f"fk:{self.ref_table}.{self.ref_column}"
        return self.kind


def _nn(c): return Check("not_null", c)
def _pk(c): return Check("unique", c)
def _rng(c, lo=None, hi=None, inc=True): return Check("range", c, lo, hi, inc)
def _len(c, n): return Check("max_len", c, max_len=n)
def _fk(c, t, rc): return Check("foreign_key", c, ref_table=t, ref_column=rc)


# The silver constraints (PRIMARY KEY = not null + unique).
SILVER_CHECKS = {
    "users": [_nn("user_id"), _pk("user_id"), _nn("name"), _len("gender", 10),
              _rng("age", 0, None, False), _nn("signup_date")],
    "captains": [_nn("captain_id"), _pk("captain_id"), _nn("name"), _rng("age", 0, None, False),
                 _rng("experience_years", 0), _rng("rating", 0, 5)],
    "rides": [_nn("ride_id"), _pk("ride_id"), _nn("user_id"), _nn("captain_id"),
              _nn("ride_date"), _rng("distance_km", 0), _rng("duration_min", 0),
              _len("ride_status", 20), _fk("user_id", "users", "user_id"),
              _fk("captain_id", "captains", "captain_id")],
    "payments": [_nn("payment_id"), _pk("payment_id"), _nn("ride_id"), _len("payment_method", 50),
                 _rng("fare", 0), _rng("discount_percent", 0, 100), _rng("discount_amount", 0),
                 _rng("final_amount", 0), _len("payment_status", 20),
                 _fk("ride_id", "rides", "ride_id")],
    "feedback": [_nn("feedback_id"), _pk("feedback_id"), _nn("ride_id"), _rng("user_rating", 0, 5),
                 _rng("captain_rating", 0, 5), _fk("ride_id", "rides", "ride_id")],
}

# Primary key of each entity.
KEYS = {"users": "user_id", "captains": "captain_id", "rides": "ride_id",
        "payments": "payment_id", "feedback": "feedback_id"}


@dataclass(frozen=True)
class TableSpec:
    name: str
    bronze_columns: list[str]
    silver_types: list[tuple[str, T.DataType]]
    checks: list[Check] = field(default_factory=list)

    @property
    def key(self) -> str:
        return KEYS[self.name]

    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, S, True) for c in self.bronze_columns])

    def silver_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.silver_types])

    def audit_schema(self) -> T.StructType:
        return T.StructType(self.bronze_schema().fields + [
            T.StructField("reason", S, False), T.StructField("run_ts", T.TimestampType(), False)])


TABLES = {n: TableSpec(n, BRONZE_COLUMNS[n], SILVER_TYPES[n], SILVER_CHECKS[n])
          for n in BRONZE_COLUMNS}
