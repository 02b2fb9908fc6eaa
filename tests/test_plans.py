"""Physical-plan checks: the shapes the scale argument in README.md relies on."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from auditlane.operators import datatests, faults, gate, rules
from auditlane.operators.sampling import landed, select_exact
from auditlane.plans import bindings as b
from auditlane.plans import flow, publish, registry
from auditlane.plans.registry import enriched_lines, line_suite, order_suite

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _frozen(spark, lake):
    return flow.freeze(lake, enriched_lines(spark, SF_SMALL))


def test_gate_shuffles_only_the_key_and_single_rows(spark, lake):
    plan = _plan(gate.evaluate(_frozen(spark, lake), line_suite(), model="m", suite="s"))
    hashed = re.findall(r"Exchange hashpartitioning\(([^,]+)", plan)
    assert len(hashed) == 1 and "trip_id" in hashed[0]
    assert plan.count("Exchange SinglePartition") == 2  # one partial row per task, per branch
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_gate_reads_only_rule_columns(spark, lake):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(gate.evaluate(_frozen(spark, lake), line_suite(), model="m", suite="s"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert columns == {"trip_id", "fare_amount", "trip_distance_miles", "passenger_count",
                       "trip_duration_minutes"}


def test_samples_are_bounded_in_each_task_and_shuffle_ids_alone(spark, lake):
    df = _frozen(spark, lake)
    every = [r.rule_id for r in rules.trips_suite()]
    rowwise = _plan(gate.offender_samples(df, rules.trips_suite(), [r for r in every if r != "trip_id_unique"]))
    # Every rule keeps its smallest ids while it scans; only these are numbered.
    assert rowwise.count("TakeOrderedAndProject(limit=10") == rowwise.count("FileScan") == len(every) - 1
    assert all(len(s.split(",")) <= 2 for s in re.findall(r"ReadSchema: struct<([^>]*)>", rowwise))
    assert re.findall(r"Exchange hashpartitioning\(([^#]+)", rowwise) in ([], ["rule_id"])
    plan = _plan(gate.offender_samples(df, rules.trips_suite(), every))
    hashed = re.findall(r"Exchange hashpartitioning\(([^#]+)", plan)
    assert [h for h in hashed if h != "rule_id"] == ["trip_id"]
    # The exchange by id carries the id and one count.
    keyed = next(line for line in plan.splitlines() if "partial_count" in line)
    assert "functions=[partial_count(1)]" in keyed


def test_samples_push_their_violation_to_the_scan(spark, lake):
    plan = _plan(gate.offender_samples(_frozen(spark, lake), rules.trips_suite(), ["fare_amount_between"]))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(fare_amount", plan)


def test_selection_reads_the_key_alone(spark, monkeypatch):
    from auditlane.operators import sampling

    seen, find = [], sampling._find_cut
    monkeypatch.setattr(sampling, "_find_cut", lambda texts, *a: seen.append(_plan(texts)) or find(texts, *a))
    df = landed(b.order_trips(spark, SF_SMALL))
    select_exact(df, 10, key_cols=["trip_id"], seed=7)
    assert len(seen) == 1 and re.findall(r"ReadSchema: struct<([^>]*)>", seen[0]) == ["trip_id:bigint"]
    select_exact(df, 10, key_cols=["vendor_id"], seed=7)  # a hot key: its rows are ranked by all columns, in one more descent
    assert len(seen) == 3 and re.findall(r"ReadSchema: struct<([^>]*)>", seen[1]) == ["vendor_id:bigint"]


def test_selection_predicate_is_a_pure_filter(spark):
    df = landed(b.order_trips(spark, SF_SMALL))
    sel = select_exact(df, 10, key_cols=["trip_id"], seed=7)
    plan = _plan(df.where(sel.predicate))
    assert "Exchange" not in plan and "Window" not in plan and "Sort " not in plan


def test_mart_tests_scan_the_fact_once_for_rows_and_once_for_keys(spark, lake):
    df = _frozen(spark, lake)
    dim = lake.read("raw", "zones", lake.write("raw", "zones", b.nation_zones(spark, SF_SMALL)).snapshot_id)
    tables = {publish.ENRICHED_MODEL: df, publish.FACT_MART: df, publish.DIM_MART: dim}
    own = [t for t in publish.MART_TESTS if t.model == publish.FACT_MART]
    plan = _plan(datatests.run_data_tests(own, tables))
    assert len(re.findall(r"FileScan parquet [^\[]*\[[^\]]*(?:trip_id|fare_amount)", plan)) == 2


def test_building_the_enrichment_starts_no_counts(spark):
    group = "build-enrichment"
    spark.sparkContext.setJobGroup(group, group)
    try:
        enriched_lines(spark, SF_SMALL)
        # Reading six footers for their schemas is all.
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 6
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_shuffled_enrichment_broadcasts_nothing(spark):
    plan = _plan(registry.q_enrich_shuffled(spark, SF_SMALL))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 7


def test_enrichment_broadcasts_the_small_dimension(spark):
    plan = _plan(enriched_lines(spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_small_null_flood_passes_gate_but_fails_mart_tests(spark, lake):
    raw = faults.null_flood(b.order_trips(spark, SF_SMALL), fraction=0.01)
    r = flow.run(spark, raw, b.nation_zones(spark, SF_SMALL), suite=order_suite(), lake=lake)
    assert r.gate.success
    assert r.outcome == flow.Outcome.MART_TESTS_FAILED
    failed = [t["test_id"] for t in r.mart_tests if not t["passed"]]
    assert failed == ["fct_trips_fare_amount_not_null"]
    assert not lake.exists("marts", "fct_trips")


def test_duplicate_dimension_key_blocks_at_the_gate(spark, lake):
    zones = b.nation_zones(spark, SF_SMALL)
    doubled = zones.unionByName(zones.where(F.col("location_id") == 1))
    r = flow.run(spark, b.order_trips(spark, SF_SMALL), doubled, suite=order_suite(), lake=lake)
    assert r.outcome == flow.Outcome.BLOCKED
    assert [f["rule_id"] for f in r.gate.failures] == ["trip_id_unique"]
