"""The gate per micro-batch: clean batches reach the mart, faulty ones are quarantined."""

from __future__ import annotations

from auditlane.operators import faults
from auditlane.plans import bindings as b
from auditlane.plans.registry import order_suite
from auditlane.sources.csv import RAW_TRIPS_TYPES
from auditlane.streaming import gate_stream, stream_mart, stream_outcomes

from .conftest import SF_SMALL

RAW_SCHEMA = ", ".join(f"{k} {v}" for k, v in RAW_TRIPS_TYPES.items())


def test_each_micro_batch_is_gated(spark, lake):
    landing = f"{lake.root}/incoming"
    clean = b.order_trips(spark, SF_SMALL)
    clean.coalesce(1).write.parquet(f"{landing}/part=0")
    faults.apply_fault(clean, "null_flood").coalesce(1).write.parquet(f"{landing}/part=1")
    stream = (spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(landing))
    q = gate_stream(stream, b.nation_zones(spark, SF_SMALL), lake=lake,
                    checkpoint_location=f"{lake.root}/_checkpoints/gated", suite=order_suite())
    q.awaitTermination(300)
    outcomes = sorted((r.success, r.failed_rules, r.rows) for r in stream_outcomes(spark, lake).collect())
    n = clean.count()
    assert outcomes == [(False, "fare_amount_not_null", n), (True, "", n)]
    assert stream_mart(spark, lake).count() == n


def test_replayed_epoch_is_idempotent(spark, lake):
    from auditlane.streaming import batch_handler

    batch = b.order_trips(spark, SF_SMALL)
    handle = batch_handler(b.nation_zones(spark, SF_SMALL), lake=lake, stream="s", suite=order_suite())
    handle(batch, 7)
    handle(batch, 7)  # the same epoch again, as after a failure before the checkpoint commit
    assert stream_mart(spark, lake).count() == batch.count()
    assert [r.batch_id for r in stream_outcomes(spark, lake).collect()] == [7]


def test_replayed_failing_epoch_leaves_one_alert(spark, lake):
    from auditlane.streaming import batch_handler, stream_alerts

    bad = faults.apply_fault(b.order_trips(spark, SF_SMALL), "null_flood")
    handle = batch_handler(b.nation_zones(spark, SF_SMALL), lake=lake, stream="s", suite=order_suite())
    handle(bad, 3)
    handle(bad, 3)
    assert stream_alerts(spark, lake).count() == 1
    assert stream_mart(spark, lake).count() == 0


def _stream(spark, lake, rows, name):
    incoming = f"{lake.root}/incoming-{name}"
    rows.coalesce(1).write.mode("append").parquet(incoming)
    q = gate_stream(spark.readStream.schema(RAW_SCHEMA).parquet(incoming), b.nation_zones(spark, SF_SMALL), lake=lake,
                    checkpoint_location=f"{lake.root}/_checkpoints/{name}", suite=order_suite())
    q.awaitTermination(300)
    assert q.exception() is None


def test_streams_on_one_lake_keep_apart(spark, lake):
    """A second stream starts at epoch 0 like the first and overwrites nothing; a restart goes on under its own name."""
    from auditlane.streaming import repeated_keys

    whole = b.order_trips(spark, SF_SMALL)
    parts = [whole.where(f"trip_id % 3 = {k}") for k in range(3)]
    _stream(spark, lake, parts[0], "one")
    _stream(spark, lake, parts[1], "two")
    assert stream_mart(spark, lake).count() == parts[0].count() + parts[1].count()
    _stream(spark, lake, parts[2], "one")  # more files, same checkpoint
    assert stream_mart(spark, lake).count() == whole.count()
    outcomes = stream_outcomes(spark, lake).collect()
    assert len({r["stream"] for r in outcomes}) == 2 and sorted(r["batch_id"] for r in outcomes) == [0, 0, 1]
    assert repeated_keys(spark, lake).count() == 0
    _stream(spark, lake, parts[2], "two")  # the same trips by another stream
    assert repeated_keys(spark, lake).count() == parts[2].count()
