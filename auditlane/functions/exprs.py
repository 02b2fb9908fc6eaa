"""Scalar expressions shared by the models, the gate and the fault transforms.

All of them are plain compositions of built-in Spark functions, so they stay JVM-side,
take part in whole-stage codegen and never need a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
)

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
_MICROS_PER_SECOND = 1_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as double; NULL when the denominator is NULL or zero.

    The guard is required, not cosmetic: under ANSI mode a division by zero raises.
    ``CASE`` evaluates the division only for rows whose guard is false.
    """
    num, den = _c(numerator), _c(denominator)
    return F.when(den.isNull() | (den == 0), F.lit(None).cast(DoubleType())).otherwise(
        num.cast(DoubleType()) / den.cast(DoubleType())
    )


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (no time zone is consulted)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz``, rounded toward minus infinity.

    ``us - pmod(us, 1e6)`` is an exact multiple of a million; dividing it in double and
    rounding to the nearest integer recovers the quotient exactly for every long value.
    """
    us = epoch_micros(ts)
    whole = us - F.pmod(us, F.lit(_MICROS_PER_SECOND))
    return F.rint(whole / F.lit(float(_MICROS_PER_SECOND))).cast("long")


def floor_to_second(ts: Column | str) -> Column:
    """A ``timestamp_ntz`` with its fraction of a second removed (rounded down).

    ``date_trunc`` would return a session-zoned timestamp; this stays ``timestamp_ntz``.
    """
    t = _c(ts)
    return F.timestamp_add("MICROSECOND", -F.pmod(epoch_micros(t), F.lit(_MICROS_PER_SECOND)), t)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end`` counted on second boundaries, as double.

    00:00:00.9 -> 00:00:01.1 counts one second (a boundary is crossed) although only
    0.2 s elapsed; negative when ``end`` precedes ``start``.
    """
    seconds = epoch_seconds(end) - epoch_seconds(start)
    return seconds.cast(DoubleType()) / F.lit(60.0)


def is_missing(col: Column | str, data_type: DataType | None = None) -> Column:
    """NULL, or NaN for floating-point columns (a batch validator treats NaN as absent)."""
    c = _c(col)
    if isinstance(data_type, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def int_cast(col: Column | str, source_type: DataType, target: str = "int") -> Column:
    """Cast to an integral type, rounding like the SQL oracle does.

    * floating point: half to even (``rint``), 2.5 -> 2 and 3.5 -> 4;
    * text and decimals: half away from zero, '2.5' -> 3 and '-2.5' -> -3;
    * integral sources: plain cast.

    Casts stay ANSI: malformed text or an out-of-range value raises rather than
    silently becoming NULL.
    """
    c = _c(col)
    if isinstance(source_type, (DoubleType, FloatType)):
        return F.rint(c).cast(target)
    if isinstance(source_type, (StringType, DecimalType)):
        exact = F.trim(c) if isinstance(source_type, StringType) else c
        return F.round(exact.cast(DecimalType(38, 10)), 0).cast(target)
    return c.cast(target)


def negate_abs(col: Column | str) -> Column:
    """``-abs(v)``; NULL stays NULL."""
    return -F.abs(_c(col))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` as double, 0.0 when undefined (whole is 0 or NULL)."""
    return F.coalesce(
        safe_divide(_c(part).cast(DoubleType()) * F.lit(100.0), _c(whole)), F.lit(0.0)
    )
