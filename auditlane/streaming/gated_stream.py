"""Gate every micro-batch of an incoming stream of raw trip files.

The scheduled run lands one batch, audits it and publishes it only if it passes.  With
Structured Streaming the same happens per trigger: ``foreachBatch`` receives the batch,
stages and enriches it, freezes it, evaluates the suite, and then

* passes  -> notes so in ``outcomes/stream=<id>/batch_id=<epoch>``, which makes the frozen batch part of the
  streaming fact mart (a pointer, no copy);
* fails   -> notes that, leaves the frozen batch as quarantine, and writes its alert.

Everything an epoch writes is under a path named after the query and the epoch, and written with ``overwrite``, so a
micro-batch replayed after a failure (the checkpoint makes Spark replay the last uncommitted
epoch) leaves the same files again.  The query's id is kept in its checkpoint: a restart goes on under
the same name, while another stream on the lake, or one with a new checkpoint, has its own and
can't touch what was published.  The outcome is written last.  The suite is evaluated per
micro-batch; ``repeated_keys`` finds keys that came again in another batch.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditlane.operators.datatests import unique_violations
from auditlane.operators.enrich import enrich_trips
from auditlane.operators.gate import run_gate
from auditlane.operators.rules import TRIPS_SUITE_NAME, Rule, trips_suite
from auditlane.operators.staging import stage_trips, stage_zones
from auditlane.sources.lake import Lake

STREAM_MART = "fct_trips_stream"
OUTCOME_SCHEMA = "rows long, success boolean, failed_rules string"


def _paths(lake: Lake) -> dict[str, str]:
    return {name: f"{lake.root}/streaming/{name}" for name in ("frozen", "outcomes", "alerts")}


def batch_handler(raw_zones: DataFrame, *, lake: Lake, stream: str | Callable[[], str], suite: Sequence[Rule] | None = None):
    """The ``foreachBatch`` function: gate one micro-batch and publish or quarantine it.

    ``stream`` names the query, at the latest when its first batch comes."""
    suite = tuple(suite or trips_suite())
    zones = stage_zones(raw_zones)
    paths = _paths(lake)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        own = f"stream={stream if isinstance(stream, str) else stream()}/batch_id={epoch_id}"
        frozen_path = f"{paths['frozen']}/{own}"
        enrich_trips(stage_trips(batch), zones).write.mode("overwrite").parquet(frozen_path)
        report = run_gate(spark.read.parquet(frozen_path), suite, model=STREAM_MART, suite=TRIPS_SUITE_NAME,
                          raise_on_failure=False, run_id=f"epoch-{epoch_id}")
        if report.payload is not None:
            spark.createDataFrame([(json.dumps(report.payload),)], "value string") \
                .write.mode("overwrite").text(f"{paths['alerts']}/{own}")
        failed = ",".join(r["rule_id"] for r in report.failures)
        spark.createDataFrame([(report.row_count, report.success, failed)], OUTCOME_SCHEMA) \
            .write.mode("overwrite").json(f"{paths['outcomes']}/{own}")

    return handle


def gate_stream(
    raw_trips: DataFrame,
    raw_zones: DataFrame,
    *,
    lake: Lake,
    checkpoint_location: str,
    suite: Sequence[Rule] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the gated stream; ``raw_trips`` is a streaming DataFrame in the raw shape."""
    started, query = threading.Event(), []

    def query_id() -> str:
        started.wait()
        return str(query[0].id)

    handle = batch_handler(raw_zones, lake=lake, stream=query_id, suite=suite)
    writer = raw_trips.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    query.append(writer.start())
    started.set()
    return query[0]


def stream_outcomes(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per processed micro-batch (``stream`` and ``batch_id`` come from the partition folders)."""
    return spark.read.json(_paths(lake)["outcomes"]).select(
        F.col("stream").cast("string"), F.col("batch_id").cast("long"), F.col("rows").cast("long"), "success", "failed_rules")


def stream_alerts(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.json(_paths(lake)["alerts"])


def stream_mart(spark: SparkSession, lake: Lake) -> DataFrame:
    """The frozen batches that passed, by partition pruning on their epochs."""
    passed = stream_outcomes(spark, lake).where("success").select(F.col("stream").alias("__stream"), F.col("batch_id").alias("__epoch"))
    frozen = spark.read.parquet(_paths(lake)["frozen"])
    same = (frozen["stream"].cast("string") == passed["__stream"]) & (frozen["batch_id"] == passed["__epoch"])
    return frozen.join(passed, same, "left_semi")


def repeated_keys(spark: SparkSession, lake: Lake, column: str = "trip_id") -> DataFrame:
    """Keys that more than one published row has, across batches and streams: one shuffle of the key."""
    return unique_violations(stream_mart(spark, lake).select(column), column)
