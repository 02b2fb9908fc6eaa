"""Typed staging projections: rename and cast raw columns into a fixed contract.

A raw table is landed with whatever columns its source had; the staging step is where the
contract is enforced.  A missing column, or one of a type that isn't meant for the contract's (a
boolean where a number should be), fails here, eagerly and without launching a job
(structural drift), while a value that cannot be cast fails in the first action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from auditlane.functions.exprs import int_cast
from auditlane.operators.contracts import diff

# The staging contracts (raw column, staged column, staged type).
TRIPS_CONTRACT: tuple[tuple[str, str, str], ...] = (
    ("trip_id", "trip_id", "bigint"),
    ("vendor_id", "vendor_id", "int"),
    ("pickup_datetime", "pickup_at", "timestamp_ntz"),
    ("dropoff_datetime", "dropoff_at", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance_miles", "double"),
    ("pickup_location_id", "pickup_location_id", "int"),
    ("dropoff_location_id", "dropoff_location_id", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("total_amount", "total_amount", "double"),
    ("payment_type", "payment_type", "int"),
)
ZONES_CONTRACT: tuple[tuple[str, str, str], ...] = (
    ("location_id", "location_id", "int"),
    ("borough", "borough", "string"),
    ("zone", "zone", "string"),
)

# Texts that stand for NULL in a column that is typed from text.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL",
    "NaN", "n/a", "nan", "null",
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


class SchemaDriftError(ValueError):
    """The raw table no longer carries a column the staging contract needs, or not in a type it can take."""

    def __init__(self, table: str, missing: list[str], present: list[str], incompatible: list[str] = ()):
        other = f", other type(s) {list(incompatible)}" if incompatible else ""
        super().__init__(
            f"staging contract for {table!r} cannot be bound: missing column(s) "
            f"{missing}{other}; raw table has {present}"
        )
        self.table = table
        self.missing = missing
        self.incompatible = list(incompatible)


def typed(col: Column, source: DataType, target: str) -> Column:
    """Cast ``col`` (of type ``source``) to ``target`` with oracle-compatible rounding."""
    if isinstance(source, StringType) and target != "string":
        col = F.when(~col.isin(*NULL_TEXTS), col)
    if target in ("int", "bigint") and not isinstance(source, _INTEGRAL):
        return int_cast(col, source, target)
    if target == "timestamp_ntz" and isinstance(source, TimestampNTZType):
        return col
    if target == "timestamp_ntz" and isinstance(source, TimestampType):
        # A zoned instant is read as its UTC wall clock, whatever the session zone is.
        return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return col.cast(target)


def stage(raw: DataFrame, contract: tuple[tuple[str, str, str], ...], table: str = "raw") -> DataFrame:
    """Project ``raw`` onto ``contract``: one cast-and-rename per column, nothing else."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    found = diff(raw.schema, {src: target for src, _, target in contract})
    missing = [c for _, c, status, *_ in found if status == "missing"]
    incompatible = [f"{c}: {actual}" for _, c, status, _, actual in found if status == "incompatible"]
    if missing or incompatible:
        raise SchemaDriftError(table, missing, list(types), incompatible)
    return raw.select(
        *[typed(F.col(src), types[src], target).alias(dst) for src, dst, target in contract]
    )


def stage_trips(raw_trips: DataFrame) -> DataFrame:
    return stage(raw_trips, TRIPS_CONTRACT, "trips")


def stage_zones(raw_zones: DataFrame) -> DataFrame:
    return stage(raw_zones, ZONES_CONTRACT, "zones")
