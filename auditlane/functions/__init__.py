"""Column-level helpers; each returns a ``pyspark.sql.Column`` and runs inside codegen."""

from auditlane.functions.exprs import (
    epoch_micros,
    epoch_seconds,
    floor_to_second,
    int_cast,
    is_missing,
    minutes_between,
    negate_abs,
    percent_of,
    safe_divide,
)

__all__ = [
    "epoch_micros",
    "epoch_seconds",
    "floor_to_second",
    "int_cast",
    "is_missing",
    "minutes_between",
    "negate_abs",
    "percent_of",
    "safe_divide",
]
