"""Declarative column rules and the trip suite.

A rule says which rows it *evaluates* and which of those *violate* it; the gate turns a
whole suite into a single distributed aggregate.  Semantics:

* missing = NULL, or NaN for floating-point columns;
* not-null: evaluates every row, violations are the missing ones;
* between: evaluates non-missing rows, bounds inclusive, ``None`` = unbounded side;
* unique: evaluates non-missing rows, violations are *all* rows of a duplicated value;
* a rule passes when evaluated == 0 or (evaluated - violations) / evaluated >= mostly;
* a rule whose column is absent fails with zero counts (the gate fails closed);
* min-rows: judged on the table's total, one evaluation, violated if there are fewer rows.  Without
  it a batch of no rows passes everything; it is off unless a suite asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from auditlane.functions.exprs import is_missing

# Rule-type names as written into results and alert payloads.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"

# Defaults of the trip suite.
TRIPS_SUITE_NAME = "int_trips_enriched_suite"
DEFAULT_MOSTLY = 0.98
FARE_MAX = 1000.0
DISTANCE_MAX = 500.0
PASSENGER_MAX = 8


@dataclass(frozen=True)
class Rule:
    rule_id: str
    column: str
    mostly: float = 1.0
    notes: str = ""
    kind: ClassVar[str] = ""

    def evaluated(self, dtype: DataType) -> Column:  # rows counted in the denominator
        raise NotImplementedError

    def violation(self, dtype: DataType) -> Column:  # row-level violation flag
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    kind: ClassVar[str] = NOT_NULL

    def evaluated(self, dtype: DataType) -> Column:
        return F.lit(True)

    def violation(self, dtype: DataType) -> Column:
        return is_missing(self.column, dtype)


@dataclass(frozen=True)
class Between(Rule):
    min_value: float | None = None
    max_value: float | None = None
    kind: ClassVar[str] = BETWEEN

    def evaluated(self, dtype: DataType) -> Column:
        return ~is_missing(self.column, dtype)

    def violation(self, dtype: DataType) -> Column:
        c = F.col(self.column)
        inside = F.lit(True)
        if self.min_value is not None:
            inside = inside & (c >= F.lit(self.min_value))
        if self.max_value is not None:
            inside = inside & (c <= F.lit(self.max_value))
        return self.evaluated(dtype) & ~inside


@dataclass(frozen=True)
class Unique(Rule):
    """Evaluated with a grouped aggregate by the gate (not row by row)."""

    kind: ClassVar[str] = UNIQUE

    def evaluated(self, dtype: DataType) -> Column:
        return ~is_missing(self.column, dtype)


@dataclass(frozen=True)
class TableRule(Rule):
    """A rule on the batch as a whole; it has no column and no offending rows."""

    def satisfied(self, rows: Column) -> Column:  # from the number of rows
        raise NotImplementedError


@dataclass(frozen=True)
class MinRows(TableRule):
    column: str = ""
    min_rows: int = 1
    kind: ClassVar[str] = ROW_COUNT

    def satisfied(self, rows: Column) -> Column:
        return rows >= F.lit(self.min_rows)


def trips_suite(
    *,
    fare_max: float = FARE_MAX,
    distance_max: float = DISTANCE_MAX,
    passenger_max: float = PASSENGER_MAX,
    mostly: float = DEFAULT_MOSTLY,
    min_rows: int | None = None,
) -> tuple[Rule, ...]:
    """The seven rules guarding the enriched trip model, in evaluation order; with ``min_rows`` an eighth."""
    return (
        NotNull("trip_id_not_null", "trip_id",
                notes="a trip without its source key cannot be traced back"),
        Unique("trip_id_unique", "trip_id",
               notes="repeated keys point at a double-written extract"),
        NotNull("fare_amount_not_null", "fare_amount", mostly,
                notes="revenue column emptied upstream"),
        Between("fare_amount_between", "fare_amount", mostly,
                notes="fare outside the plausible range (sign flip, unit error)",
                min_value=0, max_value=fare_max),
        Between("trip_distance_miles_between", "trip_distance_miles", mostly,
                notes="distance outside the plausible range (sign flip, unit error)",
                min_value=0, max_value=distance_max),
        Between("passenger_count_between", "passenger_count", mostly,
                notes="passenger count outside what a cab carries",
                min_value=0, max_value=passenger_max),
        NotNull("trip_duration_minutes_not_null", "trip_duration_minutes", mostly,
                notes="derived duration missing: the model itself is broken"),
    ) + (() if min_rows is None else (
        MinRows("batch_min_rows", min_rows=min_rows, notes="batch empty or cut short upstream"),
    ))
