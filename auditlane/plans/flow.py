"""The staged run: land -> stage + enrich -> freeze -> gate -> publish -> mart tests.

Write-audit-publish: the enriched batch is written once (frozen) to the lake, the gate
audits that frozen snapshot, and publishing commits the *same* snapshot as the fact mart, so
what was checked is what is published, the join runs once and nothing is copied.  The marts
become visible only after both the gate and the mart data tests pass; every other outcome
leaves the previously published marts in place.

Outcome codes: 0 published, 1 blocked by the gate, 2 structural failure before the gate
(schema drift, values that cannot be typed), 3 mart data tests failed (nothing published).
Any other error, such as a lost executor or a full disk, is no outcome: it is raised.

Each stage returns a summary: rows in and out, observed by the jobs that it runs anyway, failed
rules or tests, seconds.  A run appends one row a stage to ``logs/stages`` and one to ``logs/runs``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from enum import IntEnum
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from auditlane.operators.enrich import enrich_trips
from auditlane.operators.faults import check_mode
from auditlane.operators.gate import GateReport, run_gate
from auditlane.operators.rules import TRIPS_SUITE_NAME, Rule, trips_suite
from auditlane.operators.staging import SchemaDriftError, stage_trips, stage_zones
from auditlane.plans import publish
from auditlane.session import literal_frame
from auditlane.sources import catalog
from auditlane.sources.landing import RAW_NAMESPACE, TRIPS_TABLE, ZONES_TABLE, IngestManifest, land, raw_tables
from auditlane.sources.lake import Lake, TableNotFound
from auditlane.sources.sinks import AlertSink, ResultsSink

# The gated model and where its frozen batches live.
GATED_MODEL = "int_trips_enriched"
STAGING_NAMESPACE = "staging"
RUN_LOG_SCHEMA = (
    "run_id string, fault_mode string, outcome int, outcome_name string, rows_landed long, "
    "rows_checked long, failed_rules int, published boolean, error string, "
    "started_at timestamp_ntz, finished_at timestamp_ntz"
)


STAGES = ("land", "build", "gate", "publish")
STAGE_LOG_SCHEMA = (
    "run_id string, fault_mode string, position int, stage string, status string, rows_in long, rows_out long, "
    "failed_rules int, seconds double, started_at timestamp_ntz"
)


class Outcome(IntEnum):
    PUBLISHED = 0
    BLOCKED = 1
    STRUCTURAL = 2
    MART_TESTS_FAILED = 3


@dataclass
class RunResult:
    run_id: str
    fault_mode: str
    outcome: Outcome
    manifest: IngestManifest | None
    started_at: datetime
    gate: GateReport | None = None
    mart_tests: list[dict[str, Any]] = field(default_factory=list)
    published: dict[str, int] = field(default_factory=dict)
    error: str | None = None
    stages: list[dict[str, Any]] = field(default_factory=list)

    def begin(self, stage: str) -> dict[str, Any]:
        """The log row of a stage that begins now; it is ``running`` until ``end``."""
        self.stages.append({"stage": stage, "status": "running", "rows_in": None, "rows_out": None, "failed_rules": None,
                            "seconds": None, "started_at": datetime.now(UTC).replace(tzinfo=None), "clock": time.monotonic()})
        return self.stages[-1]

    def end(self, status: str, **found: int | None) -> None:
        row = self.stages[-1]
        row |= {"status": status, "seconds": time.monotonic() - row["clock"]} | found

    def stage_rows(self) -> list[tuple]:
        """One row for each of ``STAGES``; those that weren't reached are ``skipped``."""
        none = {"status": "skipped", "rows_in": None, "rows_out": None, "failed_rules": None, "seconds": None, "started_at": None}
        by_name = {r["stage"]: r for r in self.stages}
        return [(self.run_id, self.fault_mode, k, name, *[(by_name.get(name) or none)[c] for c in
                 ("status", "rows_in", "rows_out", "failed_rules", "seconds", "started_at")]) for k, name in enumerate(STAGES)]

    def log_row(self) -> tuple:
        failed = None if self.gate is None else len(self.gate.failures)
        rows = None if self.gate is None else self.gate.row_count
        return (
            self.run_id, self.fault_mode, int(self.outcome), self.outcome.name.lower(),
            None if self.manifest is None else self.manifest.trips_rows, rows, failed, bool(self.published), self.error,
            self.started_at, datetime.now(UTC).replace(tzinfo=None),
        )


def freeze(lake: Lake, enriched: DataFrame) -> DataFrame:
    """Write the batch once and read it back: the lineage cut that gate and publish share."""
    snap = lake.write(STAGING_NAMESPACE, GATED_MODEL, enriched)
    return lake.read(STAGING_NAMESPACE, GATED_MODEL, snap.snapshot_id)


# Error conditions of values that cannot be read or typed.
VALUE_CONDITIONS = (
    "CAST_INVALID_INPUT", "CAST_OVERFLOW", "NUMERIC_VALUE_OUT_OF_RANGE", "ARITHMETIC_OVERFLOW", "MALFORMED_CSV_RECORD",
    "MALFORMED_RECORD_IN_PARSING",
)


def is_structural(exc: Exception) -> bool:
    """Whether an error is about the batch's columns or values, not about the cluster."""
    if isinstance(exc, (SchemaDriftError, AnalysisException)):
        return True
    return isinstance(exc, PySparkException) and any(f"[{c}" in str(exc) for c in VALUE_CONDITIONS)


class MartTestsFailed(RuntimeError):
    """Staged marts failed their data tests; nothing was published."""

    def __init__(self, message: str, tests: list[dict[str, Any]]):
        super().__init__(message)
        self.tests = tests


# -- stages: each callable on its own (state passes through the lake) --------------------

def land_stage(lake: Lake, trips: DataFrame, zones: DataFrame, fault: str = "none",
               key_cols: Sequence[str] = ("trip_id",)) -> dict[str, Any]:
    """Stage 1: land raw tables (optionally with a fault); returns the landing summary."""
    seen = Observation()
    m = land(lake, trips, zones, fault, key_cols, seen)
    return {"manifest": m, "rows_in": seen.get["rows"], "rows_out": m.trips_rows, "trips_rows": m.trips_rows, "zones_rows": m.zones_rows, "fault_mode": m.fault_mode,
            "trips_snapshot_id": m.trips_snapshot_id, "zones_snapshot_id": m.zones_snapshot_id}


def build_stage(lake: Lake, run_id: str | None = None, manifest: IngestManifest | None = None) -> dict[str, Any]:
    """Stage 2: stage + enrich the current raw snapshots (or a given landing) and freeze.

    Raises ``SchemaDriftError`` (missing column, no job launched) or a Spark error (value
    that cannot be cast, raised by the freezing write) -- both structural failures.
    """
    run_id = run_id or uuid.uuid4().hex
    raw_trips, raw_zones = raw_tables(lake, manifest)
    seen = Observation()
    staged = stage_trips(raw_trips).observe(seen, F.count(F.lit(1)).alias("rows"))
    snap = lake.write(STAGING_NAMESPACE, GATED_MODEL, enrich_trips(staged, stage_zones(raw_zones)))
    return {"run_id": run_id, "frozen_snapshot_id": snap.snapshot_id, "rows": snap.row_count,
            "rows_in": seen.get["rows"], "rows_out": snap.row_count}


def gate_stage(lake: Lake, suite: Sequence[Rule] | None = None, *, run_id: str | None = None,
               frozen_snapshot_id: int | None = None, raise_on_failure: bool = True) -> GateReport:
    """Stage 3: gate the frozen batch; on failure results and alert are written, then
    ``GateBlocked`` is raised (unless ``raise_on_failure`` is false)."""
    frozen = lake.read(STAGING_NAMESPACE, GATED_MODEL, frozen_snapshot_id)
    return run_gate(
        frozen, tuple(suite or trips_suite()), model=GATED_MODEL, suite=TRIPS_SUITE_NAME,
        results_sink=ResultsSink(lake), alert_sink=AlertSink(lake), run_id=run_id,
        raise_on_failure=raise_on_failure,
    )


def publish_stage(lake: Lake, *, frozen_snapshot_id: int | None = None,
                  zones_snapshot_id: int | None = None, gate: GateReport | None = None) -> dict[str, Any]:
    """Stage 4: stage the marts of the frozen batch, test them, and commit only if all pass.

    ``gate`` (the report for this same frozen batch) lets tests it already answers be
    skipped."""
    frozen = lake.snapshot(STAGING_NAMESPACE, GATED_MODEL, frozen_snapshot_id)
    if frozen is None:
        raise TableNotFound(f"{STAGING_NAMESPACE}.{GATED_MODEL} has no committed snapshot under {lake.root}")
    zones = stage_zones(lake.read(RAW_NAMESPACE, ZONES_TABLE, zones_snapshot_id))
    staged = publish.stage_marts(lake, frozen, zones)
    known = publish.proven_by_gate(gate.results) if gate is not None else None
    tests = publish.test_marts(lake.spark, staged, known)
    if not all(t["passed"] for t in tests):
        raise MartTestsFailed(
            "mart data tests failed: " + ", ".join(t["test_id"] for t in tests if not t["passed"]), tests)
    return {"published": publish.commit_marts(lake, staged), "mart_tests": tests}


def run(
    spark: SparkSession,
    trips_raw: DataFrame | Callable[[], DataFrame],
    zones_raw: DataFrame | Callable[[], DataFrame],
    *,
    fault: str = "none",
    suite: Sequence[Rule] | None = None,
    lake: Lake | None = None,
    key_cols: Sequence[str] = ("trip_id",),
    register_tables: bool = False,
) -> RunResult:
    """Run every stage and map failures to outcome codes.

    Inputs are frames, or functions that read them: then drift that shows while reading (files of one
    table with other columns) is outcome 2 as well.  ``register_tables`` also shows the snapshots of a
    lake with a prefix under the plain names (``raw.trips``, ``marts.fct_trips`` ...)."""
    lake = lake or Lake(spark)
    run_id = uuid.uuid4().hex
    started = datetime.now(UTC).replace(tzinfo=None)

    check_mode(fault)
    result = RunResult(run_id, fault, Outcome.STRUCTURAL, None, started)
    try:
        result.begin("land")
        trips, zones = (x() if callable(x) else x for x in (trips_raw, zones_raw))
        landed = land_stage(lake, trips, zones, fault, key_cols)
        manifest = result.manifest = landed["manifest"]
        result.end("done", rows_in=landed["rows_in"], rows_out=landed["rows_out"])
        result.begin("build")
        if register_tables:
            catalog.register(lake, RAW_NAMESPACE, TRIPS_TABLE, manifest.trips_snapshot_id)
            catalog.register(lake, RAW_NAMESPACE, ZONES_TABLE, manifest.zones_snapshot_id)
        built = build_stage(lake, run_id, manifest)
        result.end("done", rows_in=built["rows_in"], rows_out=built["rows_out"])
    except (SchemaDriftError, PySparkException) as exc:
        if not is_structural(exc):
            raise
        result.error = f"{type(exc).__name__}: {exc}"
        result.end("failed")
        return _finish(lake, result)

    result.begin("gate")
    result.gate = gate_stage(lake, suite, run_id=run_id, frozen_snapshot_id=built["frozen_snapshot_id"],
                             raise_on_failure=False)
    result.end("done" if result.gate.success else "blocked", rows_in=built["rows_out"], rows_out=result.gate.row_count if result.gate.success else 0,
               failed_rules=len(result.gate.failures))
    if not result.gate.success:
        result.outcome = Outcome.BLOCKED
        result.error = "gate blocked: " + ", ".join(r["rule_id"] for r in result.gate.failures)
        return _finish(lake, result)

    result.begin("publish")
    try:
        done = publish_stage(lake, frozen_snapshot_id=built["frozen_snapshot_id"],
                             zones_snapshot_id=manifest.zones_snapshot_id, gate=result.gate)
    except MartTestsFailed as exc:
        result.mart_tests = exc.tests
        result.outcome = Outcome.MART_TESTS_FAILED
        result.error = str(exc)
        result.end("failed", rows_in=result.gate.row_count, rows_out=0, failed_rules=sum(not t["passed"] for t in exc.tests))
        return _finish(lake, result)
    result.end("done", rows_in=result.gate.row_count, rows_out=result.gate.row_count, failed_rules=0)
    result.mart_tests = done["mart_tests"]
    result.published = done["published"]
    result.outcome = Outcome.PUBLISHED
    if register_tables:
        for name, sid in result.published.items():
            catalog.register(lake, publish.MARTS_NAMESPACE, name, sid)
    return _finish(lake, result)


def _finish(lake: Lake, result: RunResult) -> RunResult:
    lake.spark.createDataFrame([result.log_row()], RUN_LOG_SCHEMA).write.mode("append").json(
        f"{lake.root}/logs/runs"
    )
    literal_frame(lake.spark, result.stage_rows(), STAGE_LOG_SCHEMA).write.mode("append").json(f"{lake.root}/logs/stages")
    return result


def stage_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(STAGE_LOG_SCHEMA).json(f"{lake.root}/logs/stages")


def run_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(f"{lake.root}/logs/runs").orderBy(F.col("started_at"))
