"""Gate verdicts, counts and edge semantics; samples and alert payload."""

from __future__ import annotations

import json

import pytest

from auditlane.operators import gate, rules
from auditlane.operators.rules import Between, NotNull, Unique
from auditlane.plans.registry import enriched_lines, enriched_orders, line_suite, order_suite

from .conftest import SF_CHECK


def _results(df, suite):
    rows = gate.evaluate(df, suite, model="m", suite="s").collect()
    return {r.rule_id: r for r in rows}


def test_clean_orders_pass_every_rule(spark):
    res = _results(enriched_orders(spark, SF_CHECK), order_suite())
    assert len(res) == 7 and all(r.success for r in res.values())
    assert {r.element_count for r in res.values()} == {15000}


def test_dirty_lines_fail_uniqueness_only(spark):
    res = _results(enriched_lines(spark, SF_CHECK), line_suite())
    failed = {k for k, r in res.items() if not r.success}
    assert failed == {"trip_id_unique"}
    assert res["trip_id_unique"].unexpected_count == 25953
    assert res["trip_id_unique"].unexpected_percent == pytest.approx(43.255)


def test_reference_fare_bound_fails_on_line_prices(spark):
    res = _results(enriched_lines(spark, SF_CHECK), rules.trips_suite())
    assert res["fare_amount_between"].unexpected_count == 59955 and not res["fare_amount_between"].success


def test_mostly_boundary_is_inclusive(spark):
    df = spark.createDataFrame([(i, None if i < 2 else 1.0) for i in range(100)], "trip_id long, x double")
    res = _results(df, (NotNull("x_nn", "x", 0.98),))
    assert res["x_nn"].success and res["x_nn"].unexpected_count == 2
    res = _results(df, (NotNull("x_nn", "x", 0.99),))
    assert not res["x_nn"].success


def test_between_ignores_missing_and_all_null_passes(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "trip_id long, fare double")
    res = _results(df, (Between("b", "fare", 0.98, min_value=0, max_value=10), NotNull("n", "fare", 0.98)))
    assert res["b"].success and res["b"].evaluated_count == 0 and res["b"].unexpected_percent == 0.0
    assert not res["n"].success and res["n"].unexpected_percent == 100.0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 5.0)], "trip_id long, fare double")
    res = _results(df, (NotNull("n", "fare"), Between("b", "fare", min_value=0, max_value=1)))
    assert res["n"].unexpected_count == 1
    assert res["b"].evaluated_count == 1 and res["b"].unexpected_count == 1


def test_unique_counts_every_copy_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "trip_id long")
    res = _results(df, (Unique("u", "trip_id"),))["u"]
    assert (res.element_count, res.missing_count, res.evaluated_count, res.unexpected_count) == (6, 2, 4, 3)


def test_empty_batch_passes_with_zero_counts(spark):
    df = spark.createDataFrame([], "trip_id long, fare_amount double, trip_distance_miles double, "
                                   "passenger_count int, trip_duration_minutes double")
    res = _results(df, rules.trips_suite())
    assert all(r.success and r.element_count == 0 for r in res.values())


def test_rule_on_missing_column_fails_closed(spark):
    df = spark.createDataFrame([(1,)], "trip_id long")
    res = _results(df, (NotNull("gone", "fare_amount"),))["gone"]
    assert not res.success and res.unexpected_count == 0


def test_samples_are_smallest_ids_per_failed_rule(spark):
    df = spark.createDataFrame([(i, -1.0 if i % 3 == 0 else 1.0) for i in range(1, 61)] + [(5, 1.0)],
                               "trip_id long, fare double")
    suite = (Between("neg", "fare", min_value=0), Unique("u", "trip_id"))
    got = gate.offender_samples(df, suite, ["neg", "u"], k=10).collect()
    by_rule = {}
    for r in got:
        by_rule.setdefault(r.rule_id, []).append((r.rank, r.row_id))
    assert [i for _, i in sorted(by_rule["neg"])] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 30]
    assert by_rule["u"] == [(1, 5)]


def test_samples_keep_the_type_of_the_id(spark, lake):
    from auditlane.sources.sinks import AlertSink

    df = spark.createDataFrame([("a-1", -1.0), ("a-2", 1.0), ("a-2", -2.0), (None, -3.0)], "trip_id string, fare double")
    suite = (Between("fare", "fare", min_value=0), Unique("u", "trip_id"))
    got = sorted((r.rule_id, r.rank, r.row_id) for r in gate.offender_samples(df, suite).collect())
    assert got == [("fare", 1, "a-1"), ("fare", 2, "a-2"), ("fare", 3, None), ("u", 1, "a-2")]
    sink = AlertSink(lake)
    with pytest.raises(gate.GateBlocked) as blocked:
        gate.run_gate(df, suite, model="m", suite="s", alert_sink=sink)
    assert [f["sample_trip_ids"] for f in blocked.value.payload["failures"]] == [["a-1", "a-2", None], ["a-2"]]
    assert sink.last(spark)["failures"][1]["sample_trip_ids"] == ["a-2"]


def test_run_gate_raises_with_payload_and_alerts(spark, lake):
    from auditlane.sources.sinks import AlertSink, ResultsSink

    df = enriched_lines(spark, SF_CHECK)
    sink = AlertSink(lake)
    with pytest.raises(gate.GateBlocked) as info:
        gate.run_gate(df, line_suite(), model="int_trips_enriched", suite="s",
                      alert_sink=sink, results_sink=ResultsSink(lake))
    payload = info.value.payload
    assert payload["success"] is False and payload["failed_expectation_count"] == 1
    (failure,) = payload["failures"]
    assert failure["expectation_type"] == rules.UNIQUE and failure["column"] == "trip_id"
    assert failure["unexpected_count"] == 25953 and len(failure["sample_trip_ids"]) == 10
    assert failure["sample_trip_ids"] == sorted(failure["sample_trip_ids"])
    last = sink.last(spark)
    assert last["row_count"] == 60000 and last["failures"][0]["column"] == "trip_id"
    assert ResultsSink(lake).read(spark).count() == 7
    json.dumps(payload)


def test_clean_gate_emits_no_alert(spark, lake):
    from auditlane.sources.sinks import AlertSink

    sink = AlertSink(lake)
    report = gate.run_gate(enriched_orders(spark, SF_CHECK), order_suite(), model="m", suite="s", alert_sink=sink)
    assert report.success and report.row_count == 15000 and report.payload is None
    assert sink.last(spark) is None


def test_no_raise_mode_still_reports(spark):
    report = gate.run_gate(enriched_lines(spark, SF_CHECK), line_suite(), model="m", suite="s",
                           raise_on_failure=False)
    assert not report.success and [f["rule_id"] for f in report.failures] == ["trip_id_unique"]


def test_unique_rule_on_non_id_column_samples_ids_of_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "a")], "trip_id long, k string")
    got = gate.offender_samples(df, (Unique("k_unique", "k"),), ["k_unique"]).collect()
    assert sorted((r.rank, r.row_id) for r in got) == [(1, 1), (2, 3), (3, 5)]
