"""Lake snapshots, landing, CSV round trip, data tests and the staged run's outcomes."""

from __future__ import annotations

from auditlane.operators import datatests
from auditlane.operators.staging import stage_trips, stage_zones
from auditlane.plans import bindings as b
from auditlane.plans import flow, publish
from auditlane.plans.registry import line_suite, order_suite
from auditlane.sources import csv, landing
from auditlane.sources.sinks import AlertSink

from .conftest import SF_CHECK, SF_SMALL


def test_land_writes_snapshots_and_manifest(spark, lake):
    m = landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    assert m.trips_rows == b.table(spark, SF_SMALL, "orders").count() and m.zones_rows == 25
    assert m.trips_snapshot_id is not None and m.zones_snapshot_id is not None
    assert landing.manifests(spark, lake).count() == 1


def test_land_is_a_full_refresh_with_history(spark, lake):
    for _ in range(2):
        m = landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    trips, _ = landing.raw_tables(lake)
    assert trips.count() == m.trips_rows
    assert lake.history("raw", "trips").count() == 2


def test_land_dup_pk_and_drift(spark, lake):
    m = landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), "dup_pk")
    assert m.trips_rows > b.table(spark, SF_SMALL, "orders").count()
    landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), "schema_drift")
    trips, _ = landing.raw_tables(lake)
    assert "trip_distance_mi" in trips.columns and "trip_distance" not in trips.columns


def test_land_rejects_unknown_mode_before_io(spark, lake):
    import pytest

    with pytest.raises(ValueError, match="no fault is called"):
        landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), "bogus")
    assert not lake.exists("raw", "trips")


def test_csv_round_trip_keeps_values(spark, lake):
    src = b.order_trips(spark, SF_SMALL)
    path = f"{lake.root}/csv/trips"
    csv.write_csv(src, path)
    back = csv.read_trips_csv(spark, path)
    assert back.columns == src.columns and {t for _, t in back.dtypes} == {"string"}
    back, src = stage_trips(back), stage_trips(src)
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_csv_renamed_header_lands_under_new_name(spark, lake):
    path = f"{lake.root}/csv/drift"
    csv.write_csv(b.order_trips(spark, SF_SMALL).withColumnRenamed("trip_distance", "trip_distance_mi"), path)
    assert "trip_distance_mi" in csv.read_trips_csv(spark, path).columns


def test_data_tests_count_values_and_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 5), (3, None), (None, 7)], "k long, p long")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    tables = {"t": df, "p": parent}
    tests = (
        datatests.DataTest("u", "unique", "t", "k"),
        datatests.DataTest("n", "not_null", "t", "k"),
        datatests.DataTest("r", "relationships", "t", "k", "p", "k"),
        datatests.DataTest("a", "accepted_values", "t", "p", values=(1, 2)),
    )
    got = {r.test_id: r.failures for r in datatests.run_data_tests(tests, tables).collect()}
    assert got == {"u": 1, "n": 1, "r": 1, "a": 2}


def test_run_clean_publishes_and_blocked_keeps_previous_marts(spark, lake):
    clean = flow.run(spark, b.order_trips(spark, SF_CHECK), b.nation_zones(spark, SF_CHECK),
                     suite=order_suite(), lake=lake)
    assert clean.outcome == flow.Outcome.PUBLISHED
    assert all(t["passed"] for t in clean.mart_tests)
    fct_id = lake.current_snapshot_id(publish.MARTS_NAMESPACE, publish.FACT_MART)
    assert publish.read_marts(lake)[publish.FACT_MART].count() == 15000

    for mode in ("null_flood", "dup_pk", "negative_values"):
        r = flow.run(spark, b.order_trips(spark, SF_CHECK), b.nation_zones(spark, SF_CHECK),
                     fault=mode, suite=order_suite(), lake=lake)
        assert r.outcome == flow.Outcome.BLOCKED, mode
        assert all(f["unexpected_count"] > 0 and f["sample_trip_ids"] for f in r.gate.payload["failures"])
    assert lake.current_snapshot_id(publish.MARTS_NAMESPACE, publish.FACT_MART) == fct_id
    assert AlertSink(lake).last(spark)["success"] is False

    drift = flow.run(spark, b.order_trips(spark, SF_CHECK), b.nation_zones(spark, SF_CHECK),
                     fault="schema_drift", suite=order_suite(), lake=lake)
    assert drift.outcome == flow.Outcome.STRUCTURAL and drift.gate is None
    log = flow.run_log(spark, lake).collect()
    assert [r.outcome for r in log] == [0, 1, 1, 1, 2]


def test_blocked_run_never_creates_marts(spark, lake):
    r = flow.run(spark, b.line_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL),
                 suite=line_suite(), lake=lake)
    assert r.outcome == flow.Outcome.BLOCKED
    assert not lake.exists(publish.MARTS_NAMESPACE, publish.FACT_MART)


def test_missing_table_raises_a_clear_error(spark, lake):
    import pytest

    from auditlane.sources.lake import TableNotFound

    with pytest.raises(TableNotFound, match="staging.int_trips_enriched"):
        lake.read("staging", "int_trips_enriched")
    assert lake.current_snapshot_id("raw", "trips") is None


def test_lake_paths_are_hadoops_to_resolve(spark, tmp_path):
    from auditlane.sources.lake import Lake

    assert Lake(spark, "/data/lake/").root == "/data/lake"  # the default file system, whatever it is
    assert Lake(spark, "s3a://bucket/lake/").root == "s3a://bucket/lake"


def test_no_temporary_lake_off_local_masters(spark, monkeypatch):
    import pytest

    from auditlane import session

    monkeypatch.setattr(session, "_runs_in_this_process", lambda s: False)
    with pytest.raises(RuntimeError, match="every executor"):
        session.ensure_lake_root(spark)


def test_last_commit_wins(spark, lake):
    a = lake.write_snapshot("raw", "t", spark.range(1))
    b_ = lake.write_snapshot("raw", "t", spark.range(2))
    lake.commit(b_)
    assert lake.read("raw", "t").count() == 2
    lake.commit(a)
    assert lake.read("raw", "t").count() == 1 and lake.current_snapshot_id("raw", "t") == a.snapshot_id
    assert lake.read("raw", "t", b_.snapshot_id).count() == 2
    assert {r["snapshot_id"]: r["row_count"] for r in lake.history("raw", "t").collect()} == {a.snapshot_id: 1, b_.snapshot_id: 2}


def test_only_the_batchs_own_errors_are_structural(spark, lake, monkeypatch):
    import pytest
    from pyspark.errors import PySparkException

    def lost(*_):
        raise PySparkException("executor lost")

    monkeypatch.setattr(flow, "build_stage", lost)
    with pytest.raises(PySparkException, match="executor lost"):
        flow.run(spark, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), lake=lake)


def test_run_log_keeps_the_whole_error(spark, lake):
    from pyspark.sql import functions as F

    raw = b.order_trips(spark, SF_SMALL).withColumn("fare_amount", F.lit("abc"))
    r = flow.run(spark, raw, b.nation_zones(spark, SF_SMALL), suite=order_suite(), lake=lake)
    assert r.outcome == flow.Outcome.STRUCTURAL
    assert flow.run_log(spark, lake).first().error == r.error and "abc" in r.error


def test_one_copy_of_the_batch_is_published(spark, lake):
    r = flow.run(spark, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), suite=order_suite(), lake=lake)
    assert r.outcome == flow.Outcome.PUBLISHED
    mart = lake.snapshot(publish.MARTS_NAMESPACE, publish.FACT_MART)
    assert mart.path == lake.snapshot(flow.STAGING_NAMESPACE, flow.GATED_MODEL).path


def test_zones_csv_and_source_registry(spark, lake):
    src = b.nation_zones(spark, SF_SMALL)
    csv.write_csv(src, f"{lake.root}/csv/zones")
    back = csv.read_zones_csv(spark, f"{lake.root}/csv/zones")
    assert stage_zones(back).exceptAll(stage_zones(src)).count() == 0
    landing.land(lake, b.order_trips(spark, SF_SMALL), back)
    assert landing.read_source(lake, "raw.zones").count() == 25
    assert landing.read_source(lake, "raw.trips").limit(1).count() == 1


def test_catalog_tables_follow_published_snapshots(spark, lake):
    import pytest

    from auditlane.sources import catalog
    from auditlane.sources.lake import TableNotFound

    with pytest.raises(TableNotFound):
        catalog.table(spark, "marts.no_such_table")
    r = flow.run(spark, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL),
                 suite=order_suite(), lake=lake, register_tables=True)
    assert r.outcome == flow.Outcome.PUBLISHED
    n = b.table(spark, SF_SMALL, "orders").count()
    assert spark.sql("SELECT count(*) FROM marts.fct_trips").first()[0] == n
    assert spark.sql("SELECT count(*) FROM raw.zones").first()[0] == 25
    assert catalog.table(spark, "marts.dim_zones").count() == 25


def test_stage_functions_chain_through_the_lake(spark, lake):
    import pytest

    from auditlane.operators.gate import GateBlocked

    landed = flow.land_stage(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    built = flow.build_stage(lake)
    assert built["rows"] == landed["trips_rows"]
    report = flow.gate_stage(lake, order_suite())
    assert report.success and report.row_count == landed["trips_rows"]
    done = flow.publish_stage(lake)
    assert publish.read_marts(lake)[publish.FACT_MART].count() == landed["trips_rows"]
    assert set(done["published"]) == {publish.FACT_MART, publish.DIM_MART}

    flow.land_stage(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL), "dup_pk")
    flow.build_stage(lake)
    with pytest.raises(GateBlocked) as info:
        flow.gate_stage(lake, order_suite())
    assert info.value.payload["failures"][0]["expectation_type"] == "expect_column_values_to_be_unique"


def test_gate_proven_mart_tests_match_running_them(spark, lake):
    from auditlane.operators.gate import run_gate
    from auditlane.operators.rules import TRIPS_SUITE_NAME

    flow.land_stage(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    built = flow.build_stage(lake)
    frozen = lake.read(flow.STAGING_NAMESPACE, flow.GATED_MODEL, built["frozen_snapshot_id"])
    report = run_gate(frozen, order_suite(), model=flow.GATED_MODEL, suite=TRIPS_SUITE_NAME)
    zones = flow.stage_zones(landing.raw_tables(lake)[1])
    staged = publish.stage_marts(lake, lake.snapshot(flow.STAGING_NAMESPACE, flow.GATED_MODEL), zones)
    known = publish.proven_by_gate(report.results)
    assert set(known) == {"fct_trips_trip_id_unique", "fct_trips_trip_id_not_null", "int_trips_enriched_trip_id_unique",
                          "int_trips_enriched_trip_id_not_null", "int_trips_enriched_trip_duration_minutes_not_null"}
    assert publish.test_marts(spark, staged, known) == publish.test_marts(spark, staged)


def test_uncastable_value_is_a_structural_failure(spark, lake):
    from pyspark.sql import functions as F

    raw = b.order_trips(spark, SF_SMALL).withColumn(
        "passenger_count", F.when(F.col("trip_id") == 1, F.lit("abc")).otherwise(F.col("passenger_count").cast("string")))
    r = flow.run(spark, raw, b.nation_zones(spark, SF_SMALL), suite=order_suite(), lake=lake)
    assert r.outcome == flow.Outcome.STRUCTURAL and r.gate is None
    assert "abc" in r.error or "CAST" in r.error.upper()
    assert not lake.exists(publish.MARTS_NAMESPACE, publish.FACT_MART)


def test_land_leaves_plain_parquet_and_a_catalog_table(spark, lake):
    import glob

    m = landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    data = glob.glob(f"{lake.root}/raw/trips/snapshot_id={m.trips_snapshot_id}/*.parquet")
    assert data and spark.read.parquet(*data).count() == m.trips_rows
    assert spark.table(f"{lake.database('raw')}.trips").count() == m.trips_rows
    assert glob.glob(f"{lake.root}/_*") == []  # no log of our own


def test_tables_that_are_not_ours_are_left_alone(spark, lake):
    import pytest

    from auditlane.sources import catalog

    landing.land(lake, b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL))
    spark.sql("CREATE DATABASE IF NOT EXISTS theirs")
    spark.range(5).write.mode("overwrite").saveAsTable("theirs.trips")
    spark.range(3).write.mode("overwrite").option("path", f"{lake.root}/external").saveAsTable("theirs.external")
    try:
        found = lake.snapshot("raw", "trips")
        for name in ("trips", "external"):
            with pytest.raises(catalog.NotOurs):
                catalog.point(spark, "theirs", name, found.path, found.schema)
        assert spark.table("theirs.trips").count() == 5 and spark.table("theirs.external").count() == 3
        # Ours is moved, also to other columns, and a frame that was read before keeps its rows.
        catalog.point(spark, "theirs", "own", found.path, found.schema)
        before = spark.table("theirs.own")
        zones = lake.snapshot("raw", "zones")
        catalog.point(spark, "theirs", "own", zones.path, zones.schema)
        assert spark.table("theirs.own").columns == ["location_id", "borough", "zone"]
        assert before.count() == b.table(spark, SF_SMALL, "orders").count()
    finally:
        spark.sql("DROP DATABASE theirs CASCADE")


def test_queries_answer_from_the_tables_as_they_are(spark, tmp_path):
    import shutil

    from auditlane.plans import registry

    folder = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, folder)
    assert registry.q_rule_unique(spark, folder).first()["element_count"] == 6000
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", str(tmp_path / "whole.parquet"))
    import os
    os.remove(f"{folder}/lineitem.parquet")
    spark.read.parquet(str(tmp_path / "whole.parquet")).limit(100).write.parquet(f"{folder}/lineitem.parquet")
    assert registry.q_rule_unique(spark, folder).first()["element_count"] == 100


def test_orphans_are_the_same_shuffled_and_broadcast(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (3,), (3,)], "k long")
    parent = spark.createDataFrame([(1,), (4,), (None,), (4,)], "k long")
    test = datatests.DataTest("r", "relationships", "c", "k", "p", "k")
    for side in (parent.hint("broadcast"), parent.hint("merge")):
        found = datatests.relationship_violations(child, "k", side, "k")
        assert sorted(r.k for r in found.collect()) == [2, 3, 3, 3]
        assert datatests.run_data_tests([test], {"c": child, "p": side}).first().failures == 4


def test_nan_is_missing_in_mart_tests(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert datatests.not_null_violations(df, "x").count() == 2
    assert datatests.run_data_tests([datatests.DataTest("n", "not_null", "t", "x")], {"t": df}).first().failures == 2
