"""Scalar helpers: safe division, second-boundary durations, oracle-compatible int casts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from auditlane.functions import int_cast, is_missing, minutes_between, percent_of, safe_divide


def test_safe_divide_zero_null_and_values(spark):
    df = spark.createDataFrame([(10.0, 0.0), (11.0, 2.0), (5.0, None), (1.0, -0.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_divide("n", "d")).collect()]
    assert got == [None, 5.5, None, None]


def test_minutes_between_counts_second_boundaries(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:00:01.1' b "
        "union all select timestamp_ntz'2025-06-01 23:50:00', timestamp_ntz'2025-06-02 00:20:00' "
        "union all select timestamp_ntz'2025-06-01 00:10:00', timestamp_ntz'2025-06-01 00:00:00'"
    )
    got = [r[0] for r in df.select(minutes_between("a", "b")).collect()]
    assert got == [1 / 60.0, 30.0, -10.0]


def test_minutes_between_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:30:00' b")
        assert df.select(minutes_between("a", "b")).first()[0] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_int_cast_rounds_like_the_oracle(spark):
    df = spark.createDataFrame([(2.5, "2.5"), (3.5, "-2.5"), (2.7, " 7 "), (-2.5, "1e2")], "d double, s string")
    got = df.select(int_cast("d", DoubleType()).alias("d"), int_cast("s", StringType()).alias("s")).collect()
    assert [(r.d, r.s) for r in got] == [(2, 3), (4, -3), (3, 7), (-2, 100)]


def test_missing_treats_nan_as_missing_for_doubles(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(is_missing("x", DoubleType())).collect()]
    assert got == [False, True, True]


def test_percent_of_is_zero_when_undefined(spark):
    df = spark.createDataFrame([(5, 10), (0, 0), (1, None)], "u long, n long")
    got = [r[0] for r in df.select(percent_of("u", "n")).collect()]
    assert got[0] == 50.0 and got[1] == 0.0 and got[2] == 0.0 and not any(math.isnan(g) for g in got)


def test_no_python_udf_in_expressions(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    plan = df.select(safe_divide("a", "b"), F.col("a")).__getattribute__("_jdf").queryExecution().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_checkpoint_root_is_shared_or_local_only(spark):
    from auditlane.session import checkpoint_root, lake_root

    root = checkpoint_root(spark)
    assert root and lake_root(spark)


def test_staging_reads_zoned_timestamps_as_utc_wall_clock(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from auditlane.operators.staging import typed

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp'2024-03-10 07:30:00.5 UTC' as ts")  # zoned instant
        got = df.select(typed(F.col("ts"), df.schema["ts"].dataType, "timestamp_ntz").alias("t")).first().t
        assert got == dt.datetime(2024, 3, 10, 7, 30, 0, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_int_cast_from_decimal_rounds_half_away_from_zero(spark):
    from pyspark.sql.types import DecimalType

    df = spark.sql("select cast(x as decimal(10,2)) x from values (2.50), (-2.50), (2.49) t(x)")
    got = [r[0] for r in df.select(int_cast("x", DecimalType(10, 2))).collect()]
    assert got == [3, -3, 2]
