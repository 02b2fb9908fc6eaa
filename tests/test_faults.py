"""Fault transforms: exact counts, determinism, untouched columns, dispatch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditlane.operators import faults
from auditlane.operators.sampling import key_text, landed, rest_text, select_exact


def _table(spark, n):
    return spark.createDataFrame(
        [(i + 1, 10.0 + i, 1.0 + 0.1 * i) for i in range(n)],
        "trip_id long, fare_amount double, trip_distance double",
    )


def test_none_is_identity(spark):
    df = _table(spark, 100)
    assert faults.apply_fault(df, "none") is df


def test_null_flood_exact_count(spark):
    out = faults.apply_fault(_table(spark, 200), "null_flood")
    assert out.where(F.col("fare_amount").isNull()).count() == 70
    assert out.where(F.col("trip_id").isNull()).count() == 0
    assert out.schema == _table(spark, 200).schema


def test_null_flood_is_deterministic(spark):
    a = faults.apply_fault(_table(spark, 200), "null_flood").orderBy("trip_id").collect()
    b = faults.apply_fault(_table(spark, 200), "null_flood").orderBy("trip_id").collect()
    assert a == b


def test_schema_drift_renames_only(spark):
    df = _table(spark, 100)
    out = faults.apply_fault(df, "schema_drift")
    assert "trip_distance" not in out.columns and "trip_distance_mi" in out.columns
    assert [r[0] for r in out.orderBy("trip_id").select("trip_distance_mi").collect()] == \
        [r[0] for r in df.orderBy("trip_id").select("trip_distance").collect()]


def test_dup_pk_appends_ten_percent(spark):
    out = faults.apply_fault(_table(spark, 100), "dup_pk")
    assert out.count() == 110 and out.select("trip_id").distinct().count() == 100


def test_dup_pk_minimum_one_and_empty_table(spark):
    assert faults.apply_fault(_table(spark, 5), "dup_pk").count() == 6
    assert faults.apply_fault(_table(spark, 0), "dup_pk").count() == 0


def test_negative_values_same_rows_both_columns(spark):
    df = _table(spark, 200)
    out = faults.apply_fault(df, "negative_values")
    neg = out.where(F.col("fare_amount") < 0)
    assert neg.count() == 30
    assert neg.where(F.col("trip_distance") >= 0).count() == 0
    joined = out.join(df.withColumnRenamed("fare_amount", "f0"), ["trip_id"])
    assert joined.where(F.abs("fare_amount") != F.col("f0")).count() == 0


def test_unknown_mode_raises(spark):
    with pytest.raises(ValueError, match="no fault is called"):
        faults.apply_fault(_table(spark, 10), "not_a_mode")


def test_every_mode_applies(spark):
    df = _table(spark, 50)
    for mode in faults.FAULT_MODES:
        assert faults.apply_fault(df, mode).count() >= 50


def test_selection_matches_sorted_hash_on_larger_input(spark):
    df = landed(spark.range(0, 50_000).withColumnRenamed("id", "k"))
    sel = select_exact(df, 12_345, key_cols=["k"], seed=3, fanout=1, final_rows=100)
    assert df.where(sel.predicate).count() == 12_345
    h = F.md5(F.concat_ws(":", F.col("k").cast("string"), F.lit("3")))
    expect = {r.k for r in df.orderBy(h, "k").limit(12_345).collect()}
    assert {r.k for r in df.where(sel.predicate).collect()} == expect


def _hot_table(spark, identical: bool):
    """60 distinct trips plus a hot key holding 40 % of the rows."""
    rows = [(i, 10.0 + i, 1.0 + 0.1 * i) for i in range(1, 61)]
    rows += [(0, 5.0 if identical else 5.0 + j, 1.0) for j in range(40)]
    return spark.createDataFrame(rows, "trip_id long, fare_amount double, trip_distance double")


def _expected(df, n, seed):
    """Brute force: sort every stored row by its rank text and take n."""
    ranked = df.select("*", F.concat(key_text(["trip_id"], seed), rest_text(df)).alias("__h")).collect()
    assert len({r["__h"] for r in ranked}) == len(ranked)
    return sorted((r.trip_id, r.fare_amount) for r in sorted(ranked, key=lambda r: r["__h"])[:n])


@pytest.mark.parametrize("identical", [True, False])
def test_hot_group_is_split_exactly(spark, identical):
    df = landed(_hot_table(spark, identical))
    for n in (10, 35, 77):
        sel = select_exact(df, n, key_cols=["trip_id"], seed=7, fanout=1, final_rows=4)
        got = sorted((r.trip_id, r.fare_amount) for r in df.where(sel.predicate).collect())
        assert got == _expected(df, n, 7) and sel.selected == n


def test_faults_change_no_other_cell_of_a_hot_group(spark):
    """Zoned timestamps a microsecond apart, one key: only the flooded cells change."""
    df = spark.range(20).select(
        F.lit(1).cast("long").alias("trip_id"), F.lit(5.0).alias("fare_amount"), F.lit(1.0).alias("trip_distance"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id")).alias("at"))
    flooded = faults.apply_fault(df, "null_flood")
    assert flooded.where(F.col("fare_amount").isNull()).count() == 7
    assert flooded.select("at").distinct().count() == 20
    assert faults.apply_fault(df, "dup_pk").select("at").distinct().count() == 20


def test_negative_values_of_text_columns(spark):
    df = spark.createDataFrame([(k, "NA" if k == 3 else "2.5", "") for k in range(10)], "trip_id long, fare_amount string, trip_distance string")
    got = faults.negative_values(df, fraction=1.0).collect()
    assert sorted(r.fare_amount for r in got) == ["-2.5"] * 9 + ["NA"] and {r.trip_distance for r in got} == {""}


def test_faults_stay_exact_on_a_hot_identical_group(spark):
    df = _hot_table(spark, identical=True)
    flooded = faults.apply_fault(df, "null_flood")
    assert flooded.count() == 100 and flooded.where(F.col("fare_amount").isNull()).count() == 35
    assert sorted(r.trip_id for r in flooded.collect()) == sorted(r.trip_id for r in df.collect())
    negative = faults.apply_fault(df, "negative_values")
    assert negative.where(F.col("fare_amount") < 0).count() == 15
    assert negative.where((F.col("fare_amount") < 0) != (F.col("trip_distance") < 0)).count() == 0
    assert faults.apply_fault(df, "dup_pk").count() == 110
