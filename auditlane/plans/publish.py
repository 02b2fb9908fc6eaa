"""Marts and their post-build data tests.

``fct_trips`` is the enriched model in its own column order (same grain, no filter), so
publishing commits the audited snapshot itself as the fact mart: a pointer, no second copy.
``dim_zones`` is the staged dimension, written once.  Both tables are moved only after
their tests pass, the dimension first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditlane.operators.datatests import DataTest, run_data_tests
from auditlane.operators.enrich import ENRICHED_COLUMNS
from auditlane.sources.lake import Lake, Snapshot

# Mart names, their column order and the data tests declared on them.
FACT_MART = "fct_trips"
DIM_MART = "dim_zones"
MARTS_NAMESPACE = "marts"
FACT_COLUMNS: tuple[str, ...] = ENRICHED_COLUMNS
DIM_COLUMNS: tuple[str, ...] = ("location_id", "borough", "zone")
ACCEPTED_PAYMENT_TYPES = (1, 2, 3, 4)
ENRICHED_MODEL = "int_trips_enriched"

MART_TESTS: tuple[DataTest, ...] = (
    DataTest("dim_zones_location_id_unique", "unique", DIM_MART, "location_id"),
    DataTest("dim_zones_location_id_not_null", "not_null", DIM_MART, "location_id"),
    DataTest("fct_trips_trip_id_unique", "unique", FACT_MART, "trip_id"),
    DataTest("fct_trips_trip_id_not_null", "not_null", FACT_MART, "trip_id"),
    DataTest("fct_trips_pickup_location_id_relationships", "relationships", FACT_MART,
             "pickup_location_id", DIM_MART, "location_id"),
    DataTest("fct_trips_dropoff_location_id_relationships", "relationships", FACT_MART,
             "dropoff_location_id", DIM_MART, "location_id"),
    DataTest("fct_trips_payment_type_accepted_values", "accepted_values", FACT_MART,
             "payment_type", values=ACCEPTED_PAYMENT_TYPES),
    DataTest("fct_trips_fare_amount_not_null", "not_null", FACT_MART, "fare_amount"),
    DataTest("int_trips_enriched_trip_id_unique", "unique", ENRICHED_MODEL, "trip_id"),
    DataTest("int_trips_enriched_trip_id_not_null", "not_null", ENRICHED_MODEL, "trip_id"),
    DataTest("int_trips_enriched_trip_duration_minutes_not_null", "not_null", ENRICHED_MODEL, "trip_duration_minutes"),
)


def fact_mart(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def dim_mart(zones: DataFrame) -> DataFrame:
    return zones.select(*DIM_COLUMNS)


def stage_marts(lake: Lake, frozen: Snapshot, zones: DataFrame) -> dict[str, Snapshot]:
    """Both marts as snapshots that are not yet visible: the audited batch itself, and the dimension."""
    dim = lake.write_snapshot(MARTS_NAMESPACE, DIM_MART, dim_mart(zones))
    return {DIM_MART: dim, FACT_MART: frozen.named(MARTS_NAMESPACE, FACT_MART)}


def proven_by_gate(results: list[dict]) -> dict[str, int]:
    """Mart-test failures already implied by gate results on the same frozen batch.

    The fact mart is the audited batch, so for the (integral) trip id the gate's counts answer
    the unique and not-null tests of both: no duplicated non-NULL value iff the unique rule
    found none, and the NULL count is the not-null rule's.  The same holds for the duration.
    """
    by_id = {r["rule_id"]: r for r in results}

    def count(rule_id: str, column: str) -> int | None:
        r = by_id.get(rule_id)
        return None if r is None or r.get("column") != column else r.get("unexpected_count")

    known: dict[str, int] = {}
    for model in (FACT_MART, ENRICHED_MODEL):
        if count("trip_id_unique", "trip_id") == 0:
            known[f"{model}_trip_id_unique"] = 0
        if (n := count("trip_id_not_null", "trip_id")) is not None:
            known[f"{model}_trip_id_not_null"] = int(n)
    if (n := count("trip_duration_minutes_not_null", "trip_duration_minutes")) is not None:
        known[f"{ENRICHED_MODEL}_trip_duration_minutes_not_null"] = int(n)
    return known


def test_marts(spark: SparkSession, staged: dict[str, Snapshot], known: dict[str, int] | None = None) -> list[dict]:
    """Run the declared data tests on staged mart snapshots (one action, a row a test).

    ``known`` maps test ids to failure counts proven elsewhere (``proven_by_gate``); those
    tests are reported from it instead of scanning and shuffling the fact again.
    """
    known = known or {}
    tables = {name: spark.read.parquet(snap.path) for name, snap in staged.items()}
    tables[ENRICHED_MODEL] = tables[FACT_MART]
    todo = [t for t in MART_TESTS if t.test_id not in known]
    ran = {r["test_id"]: r.asDict() for r in run_data_tests(todo, tables).collect()} if todo else {}
    out = []
    for t in MART_TESTS:
        if t.test_id in ran:
            out.append(ran[t.test_id])
        else:
            failures = known[t.test_id]
            out.append({"test_id": t.test_id, "kind": t.kind, "model": t.model, "column": t.column,
                        "failures": failures, "passed": failures == 0})
    return out


def commit_marts(lake: Lake, staged: dict[str, Snapshot]) -> dict[str, int]:
    """Make the staged marts current; returns their snapshot ids."""
    return {snap.table: snap.snapshot_id for snap in lake.commit(*staged.values())}


def read_marts(lake: Lake) -> dict[str, DataFrame]:
    return {
        FACT_MART: lake.read(MARTS_NAMESPACE, FACT_MART),
        DIM_MART: lake.read(MARTS_NAMESPACE, DIM_MART),
    }
