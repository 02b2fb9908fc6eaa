"""Staging contracts, the role-playing enrichment, and the golden rows of the model."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.testing import assertDataFrameEqual

from auditlane.operators.enrich import ENRICHED_COLUMNS, enrich_trips
from auditlane.operators.staging import SchemaDriftError, stage_trips, stage_zones
from auditlane.plans import bindings as b
from auditlane.plans.registry import enriched_lines

from .conftest import SF_SMALL

RAW_TRIPS = (
    "trip_id long, vendor_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "passenger_count long, trip_distance double, pickup_location_id long, dropoff_location_id long, "
    "fare_amount double, tip_amount double, total_amount double, payment_type long"
)


def _trip(tid, start, end, miles, fare, pu=1, do=1):
    return (tid, 1, start, end, 1, miles, pu, do, fare, 0.0, fare, 1)


def _zones(spark, rows=((1, "Manhattan", "Test Zone"),)):
    return stage_zones(spark.createDataFrame(list(rows), "location_id long, borough string, zone string"))


def test_golden_rows_safe_divide_and_duration(spark):
    t0 = dt.datetime(2025, 6, 1)
    raw = spark.createDataFrame(
        [
            _trip(1, t0, t0 + dt.timedelta(minutes=10), 0.0, 10.0),
            _trip(2, t0, t0 + dt.timedelta(minutes=12), 2.0, 11.0),
            _trip(3, dt.datetime(2025, 6, 1, 23, 50), dt.datetime(2025, 6, 2, 0, 20), 5.0, 20.0),
        ],
        RAW_TRIPS,
    )
    out = enrich_trips(stage_trips(raw), _zones(spark)).select("trip_id", "fare_per_mile", "trip_duration_minutes")
    expected = spark.createDataFrame(
        [(1, None, 10.0), (2, 5.5, 12.0), (3, 4.0, 30.0)], "trip_id long, fare_per_mile double, trip_duration_minutes double"
    )
    assertDataFrameEqual(out, expected)


def test_unmatched_facts_are_kept_with_null_zones(spark):
    t0 = dt.datetime(2025, 6, 1)
    raw = spark.createDataFrame([_trip(1, t0, t0, 1.0, 5.0, pu=1, do=99)], RAW_TRIPS)
    row = enrich_trips(stage_trips(raw), _zones(spark)).first()
    assert row.pickup_zone == "Test Zone" and row.dropoff_zone is None and row.dropoff_borough is None


def test_duplicate_dimension_key_fans_out(spark):
    t0 = dt.datetime(2025, 6, 1)
    raw = spark.createDataFrame([_trip(1, t0, t0, 1.0, 5.0)], RAW_TRIPS)
    zones = _zones(spark, ((1, "A", "x"), (1, "B", "y")))
    assert enrich_trips(stage_trips(raw), zones).count() == 4


def test_enriched_schema_and_order(spark):
    df = enriched_lines(spark, SF_SMALL)
    assert tuple(df.columns) == ENRICHED_COLUMNS
    types = dict(df.dtypes)
    assert types["pickup_at"] == "timestamp_ntz" and types["trip_duration_minutes"] == "double"
    assert types["vendor_id"] == "int" and types["trip_id"] == "bigint"
    assert df.count() == b.table(spark, SF_SMALL, "lineitem").count()


def test_missing_column_is_structural_drift_without_a_job(spark):
    raw = b.order_trips(spark, SF_SMALL).withColumnRenamed("trip_distance", "trip_distance_mi")
    with pytest.raises(SchemaDriftError, match="trip_distance"):
        stage_trips(raw)


def test_derived_measures_hold_on_a_whole_table(spark):
    from pyspark.sql import functions as F

    from auditlane.plans.registry import enriched_orders

    df = enriched_orders(spark, SF_SMALL)
    bad = df.where(
        (F.col("trip_duration_minutes") <= 0)
        | (F.abs(F.col("fare_per_mile") * F.col("trip_distance_miles") - F.col("fare_amount"))
           > 1e-9 * F.abs(F.col("fare_amount")))
    )
    assert bad.count() == 0
    assert df.where(F.col("pickup_zone").isNull() | F.col("dropoff_zone").isNull()).count() == 0


def test_shuffled_join_of_a_hot_zone_equals_the_broadcast_join(spark):
    from pyspark.sql import functions as F

    def enriched(session):
        trips = stage_trips(b.line_trips(session, SF_SMALL))
        zones = stage_zones(b.nation_zones(session, SF_SMALL, drop_region="ASIA"))
        # a third of the trips share one pickup location, many as identical copies
        hot = F.when(F.col("trip_id") % 3 == 0, F.lit(1)).otherwise(F.col("pickup_location_id"))
        return enrich_trips(trips.withColumn("pickup_location_id", hot), zones)

    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = enriched(other)
    assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    left, right = (sorted(map(str, df.collect())) for df in (shuffled, enriched(spark)))
    assert left == right


def test_text_stands_for_null_in_typed_columns_only(spark):
    from auditlane.operators.staging import NULL_TEXTS, TRIPS_CONTRACT

    row = {src: "1" for src, _, _ in TRIPS_CONTRACT} | {"pickup_datetime": "2025-01-01 00:00:00", "dropoff_datetime": "NA"}
    raw = spark.createDataFrame([row | {"fare_amount": t} for t in (*NULL_TEXTS, "2.5")], ", ".join(f"{c} string" for c in row))
    got = stage_trips(raw).collect()
    assert [r.fare_amount for r in got] == [None] * len(NULL_TEXTS) + [2.5] and got[0].dropoff_at is None
    zone = stage_zones(spark.createDataFrame([("1", "", "NA")], "location_id string, borough string, zone string")).first()
    assert (zone.location_id, zone.borough, zone.zone) == (1, "", "NA")
