"""Schema contracts, batch-level rules, multiset differences, and the stage log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditlane.operators import contracts, datatests, differences, gate, rules
from auditlane.operators.staging import SchemaDriftError, stage_trips
from auditlane.plans import bindings as b
from auditlane.plans import flow, registry
from auditlane.sources.csv import RAW_TRIPS_TYPES

from .conftest import SF_SMALL


def test_column_statuses(spark):
    df = spark.createDataFrame([], "same int, wide bigint, narrow int, words string, flag boolean, more date, money decimal(10,2)")
    contract = {"gone": "int", "same": "int", "wide": "int", "narrow": "double", "words": "bigint", "flag": "double", "money": "double"}
    got = {r["column"]: r["status"] for r in contracts.schema_diff(df, contract).collect()}
    assert got == {"gone": "missing", "same": "same", "wide": "widened", "narrow": "narrowed", "words": "text", "flag": "incompatible",
                   "money": "same", "more": "extra"}


def test_schema_diff_starts_no_job_over_the_data(spark):
    boom = spark.range(3).select(F.raise_error(F.lit("read")).cast("bigint").alias("trip_id"))
    rows = contracts.schema_diff(boom, RAW_TRIPS_TYPES).collect()
    assert len(rows) == 12 and rows[0]["status"] == "same" and {r["status"] for r in rows[1:]} == {"missing"}


def test_a_column_of_another_kind_is_structural(spark, lake):
    raw = b.order_trips(spark, SF_SMALL).withColumn("fare_amount", F.col("fare_amount") > 0)
    with pytest.raises(SchemaDriftError, match="fare_amount: boolean") as info:
        stage_trips(raw)
    assert info.value.incompatible == ["fare_amount: boolean"]
    r = flow.run(spark, raw, b.nation_zones(spark, SF_SMALL), suite=order(), lake=lake)
    assert r.outcome == flow.Outcome.STRUCTURAL


def order(**more):
    return rules.trips_suite(fare_max=registry.ORDER_FARE_MAX, **more)


def test_min_rows_is_off_by_default_and_blocks_an_empty_batch(spark, lake):
    none = b.order_trips(spark, SF_SMALL).where("trip_id < 0")
    zones = b.nation_zones(spark, SF_SMALL)
    assert flow.run(spark, none, zones, suite=order(), lake=lake).outcome == flow.Outcome.PUBLISHED
    r = flow.run(spark, none, zones, suite=order(min_rows=1), lake=lake)
    assert r.outcome == flow.Outcome.BLOCKED
    (failure,) = r.gate.payload["failures"]
    assert failure["expectation_type"] == rules.ROW_COUNT and failure["sample_trip_ids"] == [] and failure["column"] == ""
    full = b.order_trips(spark, SF_SMALL)
    n = full.count()
    assert flow.run(spark, full, zones, suite=order(min_rows=n), lake=lake).outcome == flow.Outcome.PUBLISHED
    assert flow.run(spark, full, zones, suite=order(min_rows=n + 1), lake=lake).outcome == flow.Outcome.BLOCKED


def test_a_suite_of_table_rules_only(spark):
    (r,) = gate.evaluate(spark.range(5), (rules.MinRows("m", min_rows=6),), model="m", suite="s").collect()
    assert not r["success"] and r["element_count"] == 5 and r["unexpected_percent"] == 100.0


def test_multiset_difference_both_ways(spark):
    nan = float("nan")
    a = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (2, "x", nan), (3, "y", 2.0)], "k long, t string, v double")
    e = spark.createDataFrame([(1, None, 1.0), (2, "x", nan), (4, "y", 2.0), (4, "y", 2.0)], "k long, t string, v double")
    got = {(r["k"], r["t"], r["side"], r["n_rows"]) for r in differences.multiset_difference(a, e).collect()}
    assert got == {(1, None, "unexpected", 1), (3, "y", "unexpected", 1), (4, "y", "missing", 2)}
    assert differences.multiset_difference(a, a).count() == 0
    assert {(r["t"], r["side"], r["n_rows"]) for r in differences.multiset_difference(a, e, ["t"]).collect()} == {(None, "unexpected", 1), ("y", "missing", 1)}
    with pytest.raises(ValueError, match="'v'"):
        differences.multiset_difference(a, e.withColumn("v", F.lit(1)))
    plan = differences.multiset_difference(a, e)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_orphan_counts_exchange_no_fact_row(spark):
    """With broadcasts off the only exchange on the child's side carries counted keys."""
    session = spark.newSession()
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        session.conf.set(key, "-1")
    child = session.range(10_000).selectExpr("id % 7 AS k", "id")
    parent = session.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    orphans = datatests.orphan_keys(child, "k", parent, "k")
    assert {r["k"]: r["n_rows"] for r in orphans.collect()} == {k: len(range(k, 10_000, 7)) for k in (0, 3, 4, 5, 6)}
    plan = orphans._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(k")[1].split("\n")[1]
    assert "HashAggregate" in below and "partial_count" in below


def test_stage_log_of_a_clean_and_a_faulty_run(spark, lake):
    full, zones = b.order_trips(spark, SF_SMALL), b.nation_zones(spark, SF_SMALL)
    n = full.count()
    flow.run(spark, full, zones, suite=order(), lake=lake)
    rows = {r["stage"]: r for r in flow.stage_log(spark, lake).collect()}
    assert [(s, rows[s]["status"], rows[s]["rows_in"], rows[s]["rows_out"]) for s in flow.STAGES] == [(s, "done", n, n) for s in flow.STAGES]
    assert all(rows[s]["seconds"] > 0 and rows[s]["started_at"] is not None for s in flow.STAGES)
    r = flow.run(spark, full, zones, fault="dup_pk", suite=order(), lake=lake)
    mine = {x["stage"]: x for x in flow.stage_log(spark, lake).where(F.col("run_id") == r.run_id).collect()}
    assert mine["land"]["rows_in"] == n and mine["land"]["rows_out"] == n + max(1, n // 10)
    assert mine["gate"]["status"] == "blocked" and mine["gate"]["rows_out"] == 0 and mine["gate"]["failed_rules"] == 1
    assert mine["publish"]["status"] == "skipped" and mine["publish"]["seconds"] is None
