"""Deterministic fault injection: table -> table transforms that break a batch on purpose.

Used to prove that the gate catches what it should.  Row choice is an exact-size seeded
selection (``sampling.select_exact``), so counts are exact and repeatable; it picks rows by
hash of their key, not by position.  The transforms that select rows land their input first
and return it as a filter or projection of the landed files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from auditlane.functions.exprs import negate_abs
from auditlane.operators.sampling import fraction_of, landed, select_exact

# Fault modes and their default parameters.
FAULT_MODES = ("none", "null_flood", "schema_drift", "dup_pk", "negative_values")
NULL_FLOOD_COLUMN = "fare_amount"
NULL_FLOOD_FRACTION = 0.35
NULL_FLOOD_SEED = 7
DRIFT_OLD_NAME = "trip_distance"
DRIFT_NEW_NAME = "trip_distance_mi"
DUP_PK_FRACTION = 0.1
DUP_PK_SEED = 11
NEGATIVE_FRACTION = 0.15
NEGATIVE_SEED = 13
NEGATIVE_COLUMNS = ("fare_amount", "trip_distance")
DEFAULT_KEY = ("trip_id",)


def _rewrite(stored: DataFrame, chosen: Column, changes: dict) -> DataFrame:
    """Apply ``changes`` (column -> Column function) to the chosen rows only; types kept."""
    types = {c: stored.schema[c].dataType for c in changes}
    return stored.withColumns({c: F.when(chosen, fn(F.col(c)).cast(types[c])).otherwise(F.col(c)) for c, fn in changes.items()})


def null_flood(
    df: DataFrame,
    column: str = NULL_FLOOD_COLUMN,
    fraction: float = NULL_FLOOD_FRACTION,
    seed: int = NULL_FLOOD_SEED,
    key_cols: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Exactly ``int(rows * fraction)`` cells of ``column`` become NULL; type kept."""
    df = landed(df)
    sel = select_exact(df, fraction_of(fraction), key_cols=key_cols, seed=seed)
    return _rewrite(df, sel.predicate, {column: lambda c: F.lit(None)})


def schema_drift(df: DataFrame, old_name: str = DRIFT_OLD_NAME, new_name: str = DRIFT_NEW_NAME) -> DataFrame:
    """Rename one column (no-op when it is absent)."""
    return df.withColumnRenamed(old_name, new_name)


def dup_pk(
    df: DataFrame,
    fraction: float = DUP_PK_FRACTION,
    seed: int = DUP_PK_SEED,
    key_cols: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Append ``max(1, int(rows * fraction))`` existing rows again (never more than rows)."""
    df = landed(df)
    sel = select_exact(df, fraction_of(fraction, minimum=1), key_cols=key_cols, seed=seed)
    return df.unionByName(df.where(sel.predicate))


def negative_values(
    df: DataFrame,
    fraction: float = NEGATIVE_FRACTION,
    seed: int = NEGATIVE_SEED,
    columns: Sequence[str] = NEGATIVE_COLUMNS,
    key_cols: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """On one selected row set, every listed column becomes ``-abs(v)``; NULL and text that is no number stay."""
    df = landed(df)
    sel = select_exact(df, fraction_of(fraction), key_cols=key_cols, seed=seed)
    text = {c for c in columns if isinstance(df.schema[c].dataType, StringType)}
    negate = {c: (lambda v: F.coalesce(negate_abs(v.try_cast("double")).cast("string"), v)) if c in text else negate_abs for c in columns}
    return _rewrite(df, sel.predicate, negate)


def check_mode(mode: str) -> None:
    if mode not in FAULT_MODES:
        raise ValueError(f"no fault is called {mode!r}; there are {', '.join(FAULT_MODES)}")


def apply_fault(df: DataFrame, mode: str, key_cols: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Dispatch by name with default parameters; unknown names fail before any work."""
    check_mode(mode)
    if mode == "none":
        return df
    if mode == "schema_drift":
        return schema_drift(df)
    handler = {"null_flood": null_flood, "dup_pk": dup_pk, "negative_values": negative_values}[mode]
    return handler(df, key_cols=key_cols)
