"""Registered queries: each maps (spark, sf_dir) -> DataFrame over the given test tables.

Every entry runs on whole tables (no row caps, id subsets or prefixes); the limit in
``gate_samples`` is the feature itself (at most k offender ids per failed rule).
``ORACLE`` holds the equivalent DuckDB SQL, with identical column names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from auditlane.functions.exprs import floor_to_second, int_cast, minutes_between, safe_divide
from auditlane.operators import contracts, datatests, differences, enrich, faults, gate, rules, staging
from auditlane.plans import bindings as b
from auditlane.plans import oracle_sql as q
from auditlane.plans import flow, publish
from auditlane.session import lake_root
from auditlane.sources import catalog, csv, landing
from auditlane.sources.lake import Lake, TableNotFound
from auditlane.sources.sinks import AlertSink
from auditlane.streaming import gate_stream, stream_mart

Query = Callable[[SparkSession, str], DataFrame]

# Rule bounds bound to the test data (fares there are order/line prices, not cab fares).
LINE_FARE_MAX = 105_000.0
ORDER_FARE_MAX = 500_000.0
MODEL = "int_trips_enriched"

GATE_COLUMNS = (
    "rule_index", "rule_id", "rule_type", "column", "mostly", "element_count",
    "missing_count", "evaluated_count", "unexpected_count", "unexpected_percent", "success",
)


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trips(b.line_trips(spark, sf_dir))


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trips(b.order_trips(spark, sf_dir))


def staged_zones(spark: SparkSession, sf_dir: str, drop_region: str | None = None) -> DataFrame:
    return staging.stage_zones(b.nation_zones(spark, sf_dir, drop_region))


def enriched_lines(spark: SparkSession, sf_dir: str, drop_region: str | None = None) -> DataFrame:
    return enrich.enrich_trips(staged_lines(spark, sf_dir), staged_zones(spark, sf_dir, drop_region))


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_trips(staged_orders(spark, sf_dir), staged_zones(spark, sf_dir))


def frozen(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written and read back, as the gate of a run sees it; anew in each query."""
    path = f"{lake_root(spark)}/queries/frozen-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frozen_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frozen(spark, enriched_lines(spark, sf_dir))


def frozen_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frozen(spark, enriched_orders(spark, sf_dir))


def frozen_after(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    raw = faults.apply_fault(b.order_trips(spark, sf_dir), mode)
    return frozen(spark, enrich.enrich_trips(staging.stage_trips(raw), staged_zones(spark, sf_dir)))


def gate_rows(df: DataFrame, suite, batch: str | None = None) -> DataFrame:
    out = gate.evaluate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME).select(*GATE_COLUMNS)
    if batch is not None:
        out = out.select(F.lit(batch).alias("batch"), *GATE_COLUMNS)
    return out


def line_suite():
    return rules.trips_suite(fare_max=LINE_FARE_MAX)


def order_suite():
    return rules.trips_suite(fare_max=ORDER_FARE_MAX)


# -- queries ----------------------------------------------------------------------------

def q_stage_trips(spark, sf_dir):
    return staged_lines(spark, sf_dir)


def q_stage_zones(spark, sf_dir):
    return staged_zones(spark, sf_dir)


def q_cast_half_even(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    half = F.col("l_quantity") * F.lit(0.5)
    return li.select(
        "l_orderkey",
        "l_linenumber",
        int_cast(half, DoubleType()).alias("qty_half_even"),
        int_cast(half.cast("string"), StringType()).alias("qty_half_away"),
    )


def q_safe_divide(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     safe_divide("l_extendedprice", "l_discount").alias("price_per_discount"))


def q_duration_minutes(spark, sf_dir):
    t = staged_lines(spark, sf_dir)
    return t.select("trip_id", "pickup_at", "dropoff_at",
                    minutes_between("pickup_at", "dropoff_at").alias("trip_duration_minutes"))


SUBSECOND_ORIGIN = "2024-01-01 00:00:00.9"


def q_duration_subsecond(spark, sf_dir):
    ev = b.table(spark, sf_dir, "events")
    origin = F.lit(SUBSECOND_ORIGIN).cast("timestamp_ntz")
    return ev.select(
        "event_id",
        F.timestamp_diff("SECOND", floor_to_second(origin), floor_to_second("ts")).alias("elapsed_seconds"),
        minutes_between(origin, "ts").alias("elapsed_minutes"),
    )


def q_enrich_trips(spark, sf_dir):
    return enriched_lines(spark, sf_dir)


def q_enrich_orders(spark, sf_dir):
    return enriched_orders(spark, sf_dir)


DROPPED_REGION = "ASIA"


def q_enrich_unmatched(spark, sf_dir):
    return enriched_lines(spark, sf_dir, drop_region=DROPPED_REGION)


def q_enrich_shuffled(spark, sf_dir):
    """The enrichment in a session that broadcasts nothing: shuffled joins, split at hot zones by AQE."""
    session = spark.newSession()
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        session.conf.set(key, "-1")
    return enriched_lines(session, sf_dir)


def q_fct_trips(spark, sf_dir):
    return publish.fact_mart(enriched_lines(spark, sf_dir))


def q_dim_zones(spark, sf_dir):
    return publish.dim_mart(staged_zones(spark, sf_dir))


def with_price_per_discount(spark, sf_dir):
    return q_safe_divide(spark, sf_dir)


def q_rule_not_null(spark, sf_dir):
    rule = rules.NotNull("price_per_discount_not_null", "price_per_discount", rules.DEFAULT_MOSTLY)
    return gate_rows(with_price_per_discount(spark, sf_dir), (rule,))


def q_rule_unique(spark, sf_dir):
    rule = rules.Unique("trip_id_unique", "trip_id")
    return gate_rows(frozen_lines(spark, sf_dir), (rule,))


ACCTBAL_RANGE = (0.0, 10_000.0)


def q_rule_between(spark, sf_dir):
    rule = rules.Between("c_acctbal_between", "c_acctbal", rules.DEFAULT_MOSTLY,
                         min_value=ACCTBAL_RANGE[0], max_value=ACCTBAL_RANGE[1])
    return gate_rows(b.table(spark, sf_dir, "customer"), (rule,))


def q_gate_suite(spark, sf_dir):
    return gate_rows(frozen_lines(spark, sf_dir), line_suite(), "line_trips").unionByName(
        gate_rows(frozen_orders(spark, sf_dir), order_suite(), "order_trips")
    )


def q_gate_suite_reference_bounds(spark, sf_dir):
    return gate_rows(frozen_lines(spark, sf_dir), rules.trips_suite(), "line_trips")


def q_gate_verdict(spark, sf_dir):
    lines = frozen_lines(spark, sf_dir)
    batches = (
        ("line_trips", lines, line_suite()),
        ("line_trips_reference_bounds", lines, rules.trips_suite()),
        ("order_trips", frozen_orders(spark, sf_dir), order_suite()),
    )
    parts = [
        gate.verdict(gate.evaluate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME))
        .select(F.lit(name).alias("batch"), "success", "row_count", "failed_expectation_count")
        for name, df, suite in batches
    ]
    return reduce(DataFrame.unionByName, parts)


def failed_rule_ids(df: DataFrame, suite) -> list[str]:
    """Ids of failed rules (at most one small row per rule reaches the driver)."""
    results = gate.evaluate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME)
    return [r["rule_id"] for r in results.where(~F.col("success")).select("rule_id").collect()]


def q_gate_samples(spark, sf_dir):
    df = frozen_lines(spark, sf_dir)
    suite = rules.trips_suite()
    return gate.offender_samples(df, suite, failed_rule_ids(df, suite))


CHECKED_AT = datetime(2024, 1, 2, 3, 4, 5)


def alert_of(df: DataFrame, suite) -> DataFrame:
    results = gate.evaluate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME, run_id="query", checked_at=CHECKED_AT)
    return gate.build_alert(results, gate.offender_samples(df, suite, failed_rule_ids(df, suite)))


ALERT_JSON = (
    "source string, gate string, model string, suite_name string, checked_at string, success boolean, row_count long, "
    "failed_expectation_count long, failures array<struct<rule_index: int, expectation_type: string, column: string, "
    "unexpected_count: long, unexpected_percent: double, sample_trip_ids: array<long>, notes: string>>"
)
ALERT_HEADER = ("source", "gate", "model", "suite_name", "success", "row_count", "failed_expectation_count")


def alert_rows(alerts: DataFrame, *more: str) -> DataFrame:
    """Header and failure entries of alerts, one row per failed rule (sample ids as text)."""
    f = alerts.select(*ALERT_HEADER, *more, F.explode("failures").alias("f"))
    return f.select(
        *ALERT_HEADER, *more,
        *[F.col(f"f.{c}").alias(c) for c in ("rule_index", "expectation_type", "column", "unexpected_count", "unexpected_percent", "notes")],
        F.array_join(F.transform("f.sample_trip_ids", lambda x: x.cast("string")), ",").alias("sample_trip_ids"),
    )


def q_alert_payload(spark, sf_dir):
    """The alert as read back from its JSON text."""
    texts = alert_of(frozen_lines(spark, sf_dir), rules.trips_suite()).select("payload_json")
    read = texts.select(F.from_json("payload_json", ALERT_JSON).alias("a")).select("a.*")
    return alert_rows(read.withColumn("checked_at", F.substring("checked_at", 1, 19)), "checked_at")


def q_alert_failures(spark, sf_dir):
    return alert_rows(alert_of(frozen_lines(spark, sf_dir), rules.trips_suite())).drop("notes")


def q_alert_sink(spark, sf_dir):
    """Alerts read back from the sink after gating a dirty and a clean batch: only the first left one."""
    lake = scratch_lake(spark, "alerts")
    sink = AlertSink(lake)
    for df, suite in ((frozen_lines(spark, sf_dir), line_suite()), (frozen_orders(spark, sf_dir), order_suite())):
        gate.run_gate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME, alert_sink=sink, raise_on_failure=False)
    return alert_rows(spark.read.schema(ALERT_JSON).json(sink.path))


def q_fault(mode: str) -> Query:
    def run(spark, sf_dir):
        return faults.apply_fault(b.order_trips(spark, sf_dir), mode)

    run.__name__ = f"q_fault_{mode}"
    return run


HOT_KEY = ("vendor_id",)


def q_fault_hot_key(spark, sf_dir):
    """A null flood whose key has two values: exact, and no other cell of a row changes."""
    before = b.line_trips(spark, sf_dir)
    after = faults.null_flood(before, key_cols=HOT_KEY)
    return after.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("fare_amount").isNull()).alias("nulled"),
        F.count_distinct("pickup_datetime").alias("pickup_times"),
        F.count_distinct("trip_id").alias("trip_ids"),
        F.sum("passenger_count").alias("passengers"),
    )


def q_gate_after(mode: str) -> Query:
    def run(spark, sf_dir):
        return gate_rows(frozen_after(spark, sf_dir, mode), order_suite())

    run.__name__ = f"q_gate_after_{mode}"
    return run


def q_samples_after(mode: str) -> Query:
    def run(spark, sf_dir):
        df, suite = frozen_after(spark, sf_dir, mode), order_suite()
        return gate.offender_samples(df, suite, failed_rule_ids(df, suite))

    run.__name__ = f"q_samples_after_{mode}"
    return run


def q_test_unique(spark, sf_dir):
    return datatests.unique_violations(publish.fact_mart(enriched_lines(spark, sf_dir)), "trip_id")


def q_test_not_null(spark, sf_dir):
    return datatests.not_null_violations(with_price_per_discount(spark, sf_dir), "price_per_discount")


def q_test_relationships(spark, sf_dir):
    fct = publish.fact_mart(enriched_lines(spark, sf_dir))
    dim = publish.dim_mart(staged_zones(spark, sf_dir, drop_region=DROPPED_REGION))
    return datatests.relationship_violations(fct, "pickup_location_id", dim, "location_id").select(
        "trip_id", "pickup_location_id"
    )


ACCEPTED_STATUSES = ("F", "O")


def q_test_accepted_values(spark, sf_dir):
    return datatests.accepted_values_violations(
        b.table(spark, sf_dir, "orders"), "o_orderstatus", ACCEPTED_STATUSES
    )


def q_mart_tests(spark, sf_dir):
    parts = []
    for batch, df in (("line_trips", frozen_lines(spark, sf_dir)), ("order_trips", frozen_orders(spark, sf_dir))):
        tables = {publish.ENRICHED_MODEL: df, publish.FACT_MART: publish.fact_mart(df),
                  publish.DIM_MART: publish.dim_mart(staged_zones(spark, sf_dir))}
        parts.append(datatests.run_data_tests(publish.MART_TESTS, tables).select(F.lit(batch).alias("batch"), "*"))
    return reduce(DataFrame.unionByName, parts)


# -- landing, CSV, publish and whole runs (these write to a private folder of the lake) --

def scratch_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, f"{lake_root(spark)}/queries/{label}-{uuid.uuid4().hex}")


def _landed(spark: SparkSession, sf_dir: str, label: str, fault: str = "none") -> DataFrame:
    """The written manifest of one landing, beside the rows that its snapshot ids lead to."""
    lake = scratch_lake(spark, label)
    landing.land(lake, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir), fault)
    written = landing.manifests(spark, lake)
    ids = written.select("trips_snapshot_id", "zones_snapshot_id").first()
    trips = lake.read(landing.RAW_NAMESPACE, landing.TRIPS_TABLE, ids["trips_snapshot_id"])
    zones = lake.read(landing.RAW_NAMESPACE, landing.ZONES_TABLE, ids["zones_snapshot_id"])
    return written.select(
        "fault_mode", "trips_rows", "zones_rows",
        F.lit(trips.count()).cast("long").alias("trips_in_snapshot"), F.lit(zones.count()).cast("long").alias("zones_in_snapshot"))


def q_land_manifest(spark, sf_dir):
    return _landed(spark, sf_dir, "land")


def q_land_dup_pk(spark, sf_dir):
    return _landed(spark, sf_dir, "land-dup", "dup_pk")


def q_land_interleaved(spark, sf_dir):
    """Orders written first and committed last: the last commit is what readers see."""
    lake = scratch_lake(spark, "land-interleaved")
    slow = lake.write_snapshot(landing.RAW_NAMESPACE, landing.TRIPS_TABLE, b.order_trips(spark, sf_dir))
    lake.write(landing.RAW_NAMESPACE, landing.TRIPS_TABLE, b.line_trips(spark, sf_dir))
    lake.commit(slow)
    return staging.stage_trips(lake.read(landing.RAW_NAMESPACE, landing.TRIPS_TABLE))


def q_raw_table_by_name(spark, sf_dir):
    """The landed trips, read as a catalog table."""
    lake = scratch_lake(spark, "by-name")
    landing.land(lake, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir))
    return staging.stage_trips(catalog.table(spark, catalog.register(lake, landing.RAW_NAMESPACE, landing.TRIPS_TABLE)))


def q_land_twice(spark, sf_dir):
    lake = scratch_lake(spark, "land-twice")
    for _ in range(2):
        landing.land(lake, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir))
    visible = lake.read(landing.RAW_NAMESPACE, landing.TRIPS_TABLE).select(
        F.lit(1).alias("visible"), F.lit(None).cast("long").alias("written"))
    commits = lake.history(landing.RAW_NAMESPACE, landing.TRIPS_TABLE).select(
        F.lit(None).cast("int").alias("visible"), F.col("row_count").alias("written"))
    return visible.unionByName(commits).agg(
        F.count("visible").alias("visible_rows"),
        F.count("written").alias("snapshots"),
        F.sum("written").alias("rows_written"),
    )


# -- batch-level rules, contracts and differences -------------------------------------

NO_SUCH_PAYMENT = 9  # a payment type that no order has: the batch cut to it is empty
MIN_ROWS = 1


def min_rows_suite(least: int):
    return rules.trips_suite(fare_max=ORDER_FARE_MAX, min_rows=least)


def q_gate_min_rows(spark, sf_dir):
    """The order batch, and one that lost all its rows: only the rule on the table's total sees that."""
    whole = frozen_orders(spark, sf_dir)
    lost = whole.where(F.col("payment_type") == NO_SUCH_PAYMENT)
    return gate_rows(whole, min_rows_suite(MIN_ROWS), "order_trips").unionByName(gate_rows(lost, min_rows_suite(MIN_ROWS), "lost"))


def drifted_orders(spark, sf_dir):
    """Raw orders whose columns changed upstream: one renamed, one wider, one narrower, one as text, one of another kind."""
    return faults.schema_drift(b.order_trips(spark, sf_dir)).withColumns({
        "passenger_count": F.col("passenger_count").cast("double"), "payment_type": F.col("payment_type").cast("int"),
        "fare_amount": F.col("fare_amount").cast("string"), "tip_amount": F.col("tip_amount") > 0})


def q_schema_diff(spark, sf_dir):
    """Drifted trips against the raw contract, with how many values each column holds."""
    return contracts.schema_report(drifted_orders(spark, sf_dir), csv.RAW_TRIPS_TYPES)


DIFFERENCE_COLUMNS = ("vendor_id", "passenger_count", "payment_type", "fare_amount")


def q_rows_difference(spark, sf_dir):
    """What a batch with repeated and negated rows has too many and too few of, against the clean one."""
    clean = b.order_trips(spark, sf_dir)
    return differences.multiset_difference(faults.negative_values(faults.dup_pk(clean)), clean, DIFFERENCE_COLUMNS)


def q_golden_rows(spark, sf_dir):
    """Every enriched line whose measures are known beforehand, against what the model makes of it.

    Known: lines that ship on the order's date or a whole number of days off have 1,440 minutes a day, and a
    fare per mile that is the price per unit.  An empty result says that all rows are as expected.
    """
    day = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    li, o = b.table(spark, sf_dir, "lineitem"), b.table(spark, sf_dir, "orders")
    midnight = lambda c: F.col(c) == F.date_trunc("DAY", F.col(c)).cast("timestamp_ntz")
    known = li.join(o, li.l_orderkey == o.o_orderkey).where(midnight("l_shipdate") & midnight("o_orderdate")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"), (day * 1440.0).alias("trip_duration_minutes"),
        F.when(F.col("l_quantity") != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("fare_per_mile"))
    model = enriched_lines(spark, sf_dir).where(midnight("pickup_at") & midnight("dropoff_at"))
    return differences.multiset_difference(model.select(*known.columns), known).unionByName(
        known.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(None).cast("long").alias("trip_id"), F.lit(None).cast("double").alias("trip_duration_minutes"),
            F.lit(None).cast("double").alias("fare_per_mile"), F.lit("expected").alias("side"), "n_rows"))


def q_orphan_keys(spark, sf_dir):
    """Zone keys of lines that a dimension without one region lacks, with their rows."""
    fct = publish.fact_mart(enriched_lines(spark, sf_dir))
    dim = publish.dim_mart(staged_zones(spark, sf_dir, drop_region=DROPPED_REGION))
    return datatests.orphan_keys(fct, "dropoff_location_id", dim, "location_id")


def q_gate_raises(spark, sf_dir):
    """What a blocked gate raises: its message, and the alert that it carries, one row per failed rule."""
    try:
        gate.run_gate(frozen_lines(spark, sf_dir), line_suite(), model=MODEL, suite=rules.TRIPS_SUITE_NAME)
    except gate.GateBlocked as stop:
        text = spark.range(1).select(F.from_json(F.lit(json.dumps(stop.payload)), ALERT_JSON).alias("a"), F.lit(str(stop)).alias("message"))
        return alert_rows(text.select("a.*", "message"), "message")
    raise RuntimeError("the gate let the dirty batch pass")


def q_samples_without_id(spark, sf_dir):
    """The alert of a batch that lacks the id column asked for: counts stay, no id is sampled."""
    df, suite = frozen_lines(spark, sf_dir), rules.trips_suite()
    results = gate.evaluate(df, suite, model=MODEL, suite=rules.TRIPS_SUITE_NAME, run_id="query", checked_at=CHECKED_AT)
    return alert_rows(gate.build_alert(results, gate.offender_samples(df, suite, failed_rule_ids(df, suite), id_col="ride_id"))).drop("notes")


def q_fault_dispatch(spark, sf_dir):
    """Every fault by its name, and a name that is none, on the order batch: what changed, in one row a name."""
    parts = []
    for mode in (*faults.FAULT_MODES, "no_such_fault"):
        try:
            df = faults.apply_fault(b.order_trips(spark, sf_dir), mode)
        except ValueError:
            df = b.order_trips(spark, sf_dir).where("trip_id IS NULL")  # refused: nothing comes out
        distance = faults.DRIFT_NEW_NAME if faults.DRIFT_NEW_NAME in df.columns else faults.DRIFT_OLD_NAME
        parts.append(df.agg(
            F.lit(mode).alias("fault_mode"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("trip_id").alias("n_ids"),
            F.count_if(F.col("fare_amount").isNull()).alias("null_fares"), F.count_if(F.col("fare_amount") < 0).alias("negative_fares"),
            F.count_if(F.col(distance) < 0).alias("negative_distances"), F.lit(distance).alias("distance_column")))
    return reduce(DataFrame.unionByName, parts)


def q_lake_states(spark, sf_dir):
    """What readers find by name: a clear error before anything is landed, the landed rows after, the old ones when a write isn't committed."""
    lake, found = scratch_lake(spark, "states"), []

    def look(state: str) -> None:
        try:
            rows = lake.read(landing.RAW_NAMESPACE, landing.TRIPS_TABLE).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("string").alias("error"))
        except TableNotFound as missing:
            text = str(missing).replace(lake.root, "<root>")
            rows = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"), F.lit(text).alias("error"))
        found.append(rows.select(F.lit(state).alias("state"), "n_rows", "error"))

    look("empty")
    landing.land(lake, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir))
    look("landed")
    lake.write_snapshot(landing.RAW_NAMESPACE, landing.TRIPS_TABLE, b.line_trips(spark, sf_dir))
    look("written")
    return reduce(DataFrame.unionByName, found)


def q_run_stages(spark, sf_dir):
    """The stage logs of five runs, one a fault mode."""
    parts = []
    for mode in RUN_MODES:
        lake = scratch_lake(spark, f"stages-{mode}")
        flow.run(spark, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir), fault=mode, suite=order_suite(), lake=lake)
        parts.append(flow.stage_log(spark, lake).select("fault_mode", "position", "stage", "status", "rows_in", "rows_out", "failed_rules"))
    return reduce(DataFrame.unionByName, parts)


def q_csv_mixed_headers(spark, sf_dir):
    """Two files of one table with their columns in another order."""
    lake = scratch_lake(spark, "csv-mixed")
    trips, path = b.order_trips(spark, sf_dir), f"{lake.root}/landing/trips_csv"
    csv.write_csv(trips.where("trip_id % 2 = 0"), path)
    csv.write_csv(trips.where("trip_id % 2 = 1").select(*reversed(trips.columns)), path, mode="append")
    return staging.stage_trips(csv.read_trips_csv(spark, path))


# Texts that a quoted field must bring back unchanged: quotes, commas, backslashes, outer spaces.
AWKWARD = ('say "hi", x', " outer ", "back\\slash", '"', "a\\", ",", "  ", 'x""y')


def awkward_zones(spark, sf_dir):
    zones = b.nation_zones(spark, sf_dir)
    pick = F.element_at(F.array(*[F.lit(t) for t in AWKWARD]), (F.col("location_id") % len(AWKWARD) + 1).cast("int"))
    return zones.withColumn("zone", F.concat(pick, "zone", pick))


def q_csv_quoting(spark, sf_dir):
    lake = scratch_lake(spark, "csv-quoting")
    csv.write_csv(awkward_zones(spark, sf_dir), f"{lake.root}/zones")
    return staging.stage_zones(csv.read_zones_csv(spark, f"{lake.root}/zones"))


def loose_orders(spark, sf_dir):
    """Raw orders as texts of mixed kinds: whole and broken numbers, dates, null texts and junk."""
    t = b.order_trips(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    mod = lambda n, k: F.col("trip_id") % n == k
    return t.select(
        text("trip_id").alias("trip_id"),
        F.when(mod(100, 7), "NA").when(mod(100, 8), "").otherwise(text("passenger_count")).alias("passenger_count"),
        F.when(mod(10, 3), "2.5").when(mod(100, 9), "1e3").otherwise(text("passenger_count")).alias("parts"),
        F.date_format("pickup_datetime", "yyyy-MM-dd").alias("pickup_day"),
        F.when(mod(50, 1), "2024-13-45").otherwise(F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")).alias("pickup_time"),
        F.when(mod(25, 2), "abc").when(mod(25, 4), "null").otherwise(text("payment_type")).alias("payment_type"),
        F.lit("NaN").alias("nothing"))


def q_csv_inferred_types(spark, sf_dir):
    """What each column of files is whose columns aren't known, from all their values."""
    lake = scratch_lake(spark, "csv-types")
    csv.write_csv(loose_orders(spark, sf_dir), f"{lake.root}/loose")
    return csv.inferred_types(csv.read_csv(spark, f"{lake.root}/loose"))


def q_csv_roundtrip(spark, sf_dir):
    lake = scratch_lake(spark, "csv")
    path = f"{lake.root}/landing/trips_csv"
    csv.write_csv(b.order_trips(spark, sf_dir), path)
    return staging.stage_trips(csv.read_trips_csv(spark, path))


def q_publish_clean(spark, sf_dir):
    lake = scratch_lake(spark, "publish")
    result = flow.run(spark, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir),
                      suite=order_suite(), lake=lake)
    if result.outcome != flow.Outcome.PUBLISHED:
        raise RuntimeError(f"clean batch was not published: {result.error}")
    return publish.read_marts(lake)[publish.FACT_MART]


def q_publish_blocked(spark, sf_dir):
    lake = scratch_lake(spark, "blocked")
    flow.run(spark, b.line_trips(spark, sf_dir), b.nation_zones(spark, sf_dir), suite=line_suite(), lake=lake)
    log = flow.run_log(spark, lake).select("outcome", "outcome_name", "rows_landed", "rows_checked",
                                          "failed_rules", "published")
    marts = F.lit(lake.exists(publish.MARTS_NAMESPACE, publish.FACT_MART)).alias("marts_exist")
    return log.select("*", marts)


RUN_MODES = ("none", "null_flood", "dup_pk", "negative_values", "schema_drift")


def _outcomes(spark: SparkSession, runs: list[tuple[str, Lake]]) -> DataFrame:
    """What the run logs say, one row per (label, lake), and whether marts are there."""
    parts = [
        flow.run_log(spark, lake).select(F.lit(label).alias("batch"), "outcome", "rows_landed", "rows_checked", "failed_rules",
                                         F.lit(lake.exists(publish.MARTS_NAMESPACE, publish.FACT_MART)).alias("marts_exist"))
        for label, lake in runs
    ]
    return reduce(DataFrame.unionByName, parts)


def q_run_outcomes(spark, sf_dir):
    runs = []
    for mode in RUN_MODES:
        lake = scratch_lake(spark, f"run-{mode}")
        flow.run(spark, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir), fault=mode, suite=order_suite(), lake=lake)
        runs.append((mode, lake))
    return _outcomes(spark, runs).withColumnRenamed("batch", "fault_mode")


# What a CSV says in place of the fare where the order key leaves this remainder of 100, and the text it gets.
CSV_CASES = {"clean": None, "na": "NA", "nan": "NaN", "empty": "", "junk": "abc"}
CSV_REMAINDER = 7


def q_run_outcomes_csv(spark, sf_dir):
    runs = []
    for label, text in CSV_CASES.items():
        lake = scratch_lake(spark, f"csv-run-{label}")
        trips = b.order_trips(spark, sf_dir)
        if text is not None:
            fare = F.when(F.col("trip_id") % 100 == CSV_REMAINDER, F.lit(text)).otherwise(F.col("fare_amount").cast("string"))
            trips = trips.withColumn("fare_amount", fare)
        csv.write_csv(trips, f"{lake.root}/in/trips")
        csv.write_csv(b.nation_zones(spark, sf_dir), f"{lake.root}/in/zones")
        flow.run(spark, csv.read_trips_csv(spark, f"{lake.root}/in/trips"), csv.read_zones_csv(spark, f"{lake.root}/in/zones"),
                 suite=order_suite(), lake=lake)
        runs.append((label, lake))
    return _outcomes(spark, runs)


def q_stream_gate(spark, sf_dir):
    """Whole order batch arrives as files; the gated stream publishes it (one micro-batch)."""
    lake = scratch_lake(spark, "stream")
    incoming = f"{lake.root}/incoming"
    b.order_trips(spark, sf_dir).write.parquet(incoming)
    raw_schema = ", ".join(f"{k} {v}" for k, v in csv.RAW_TRIPS_TYPES.items())
    query = gate_stream(spark.readStream.schema(raw_schema).parquet(incoming), b.nation_zones(spark, sf_dir),
                        lake=lake, checkpoint_location=f"{lake.root}/_checkpoints/stream", suite=order_suite())
    query.awaitTermination()
    return stream_mart(spark, lake).select(*publish.FACT_COLUMNS)


def q_csv_zones_roundtrip(spark, sf_dir):
    lake = scratch_lake(spark, "csv-zones")
    path = f"{lake.root}/landing/zones_csv"
    csv.write_csv(b.nation_zones(spark, sf_dir), path)
    return staging.stage_zones(csv.read_zones_csv(spark, path))

QUERIES: dict[str, Query] = {
    "stage_trips": q_stage_trips,
    "stage_zones": q_stage_zones,
    "cast_half_even": q_cast_half_even,
    "safe_divide": q_safe_divide,
    "duration_minutes": q_duration_minutes,
    "duration_subsecond": q_duration_subsecond,
    "enrich_trips": q_enrich_trips,
    "enrich_orders": q_enrich_orders,
    "enrich_unmatched": q_enrich_unmatched,
    "enrich_shuffled": q_enrich_shuffled,
    "fct_trips": q_fct_trips,
    "dim_zones": q_dim_zones,
    "rule_not_null": q_rule_not_null,
    "rule_unique": q_rule_unique,
    "rule_between": q_rule_between,
    "gate_suite": q_gate_suite,
    "gate_suite_reference_bounds": q_gate_suite_reference_bounds,
    "gate_verdict": q_gate_verdict,
    "gate_samples": q_gate_samples,
    "alert_payload": q_alert_payload,
    "alert_failures": q_alert_failures,
    "alert_sink": q_alert_sink,
    "fault_null_flood": q_fault("null_flood"),
    "fault_dup_pk": q_fault("dup_pk"),
    "fault_negative_values": q_fault("negative_values"),
    "fault_schema_drift": q_fault("schema_drift"),
    "fault_hot_key": q_fault_hot_key,
    "gate_after_null_flood": q_gate_after("null_flood"),
    "gate_after_dup_pk": q_gate_after("dup_pk"),
    "gate_after_negative_values": q_gate_after("negative_values"),
    "samples_after_null_flood": q_samples_after("null_flood"),
    "samples_after_dup_pk": q_samples_after("dup_pk"),
    "samples_after_negative_values": q_samples_after("negative_values"),
    "test_unique": q_test_unique,
    "test_not_null": q_test_not_null,
    "test_relationships": q_test_relationships,
    "test_accepted_values": q_test_accepted_values,
    "mart_tests": q_mart_tests,
    "land_manifest": q_land_manifest,
    "land_dup_pk": q_land_dup_pk,
    "land_twice": q_land_twice,
    "land_interleaved": q_land_interleaved,
    "raw_table_by_name": q_raw_table_by_name,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_zones_roundtrip": q_csv_zones_roundtrip,
    "publish_clean": q_publish_clean,
    "publish_blocked": q_publish_blocked,
    "run_outcomes": q_run_outcomes,
    "run_outcomes_csv": q_run_outcomes_csv,
    "stream_gate": q_stream_gate,
    "csv_mixed_headers": q_csv_mixed_headers,
    "csv_quoting": q_csv_quoting,
    "csv_inferred_types": q_csv_inferred_types,
    "gate_min_rows": q_gate_min_rows,
    "schema_diff": q_schema_diff,
    "rows_difference": q_rows_difference,
    "golden_rows": q_golden_rows,
    "run_stages": q_run_stages,
    "orphan_keys": q_orphan_keys,
    "gate_raises": q_gate_raises,
    "samples_without_id": q_samples_without_id,
    "fault_dispatch": q_fault_dispatch,
    "lake_states": q_lake_states,
}


def _verdict_sql(name: str, batch: str, suite: list[tuple]) -> str:
    return f"""
SELECT '{name}' AS batch, coalesce(bool_and(success), TRUE) AS success,
       CAST(coalesce(max(element_count), 0) AS BIGINT) AS row_count,
       CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS failed_expectation_count
FROM ({q.decided(q.rule_metrics(batch, suite))}) d
"""


def _gate_after_sql(fault_sql: str) -> str:
    return q.gate_results(q.enriched(fault_sql, q.zones_raw()), q.suite_rules(ORDER_FARE_MAX))


def _outcome_sql(label: str, raw: str, column: str = "fault_mode") -> str:
    """0, 1 or 3, from the seven rules and the mart test that tolerates no missing fare."""
    batch = q.enriched(raw, q.zones_raw())
    gate_sql = q.decided(q.rule_metrics(batch, q.suite_rules(ORDER_FARE_MAX)))
    return f"""
SELECT '{label}' AS {column}, CASE WHEN failed > 0 THEN 1 WHEN missing > 0 THEN 3 ELSE 0 END AS outcome,
       rows AS rows_landed, rows AS rows_checked, CAST(failed AS INTEGER) AS failed_rules,
       failed = 0 AND missing = 0 AS marts_exist
FROM (SELECT count(*) FILTER (WHERE NOT success) AS failed, max(element_count) AS rows,
             max(missing_count) FILTER (WHERE rule_id = 'fare_amount_not_null') AS missing FROM ({gate_sql}) g) x
"""


def _csv_outcome_sql(label: str) -> str:
    hit = f"o.trip_id % 100 = {CSV_REMAINDER}"
    if label == "clean":
        return _outcome_sql(label, q.ORDER_RAW, "batch")
    if label == "junk":
        clean = _outcome_sql(label, q.ORDER_RAW, "batch")
        return f"""
SELECT batch, CASE WHEN junk > 0 THEN 2 ELSE outcome END AS outcome, rows_landed,
       CASE WHEN junk > 0 THEN NULL ELSE rows_checked END AS rows_checked,
       CASE WHEN junk > 0 THEN NULL ELSE failed_rules END AS failed_rules, marts_exist AND junk = 0 AS marts_exist
FROM ({clean}) c, (SELECT count(*) FILTER (WHERE {hit}) AS junk FROM ({q.ORDER_RAW}) o) j
"""
    missing = f"SELECT o.* REPLACE (CASE WHEN {hit} THEN NULL ELSE o.fare_amount END AS fare_amount) FROM ({q.ORDER_RAW}) o"
    return _outcome_sql(label, missing, "batch")


def _alert_sql(fare_max: float, more: str = "") -> str:
    suite = q.suite_rules(fare_max)
    notes = " ".join(f"WHEN '{r.rule_id}' THEN '{r.notes}'" for r in rules.trips_suite())
    return f"""
WITH g AS ({q.decided(q.rule_metrics(q.line_enriched(), suite))}),
s AS ({q.offender_samples(q.line_enriched(), suite)}),
ids AS (SELECT rule_id, string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY rank) AS sample_trip_ids
        FROM s GROUP BY rule_id)
SELECT '{gate.ALERT_SOURCE}' AS source, '{gate.GATE_NAME}' AS gate, '{MODEL}' AS model,
       '{rules.TRIPS_SUITE_NAME}' AS suite_name,
       (SELECT bool_and(success) FROM g) AS success,
       (SELECT CAST(max(element_count) AS BIGINT) FROM g) AS row_count,
       (SELECT CAST(count(*) AS BIGINT) FROM g WHERE NOT success) AS failed_expectation_count,
       g.rule_index, g.rule_type AS expectation_type, g."column", g.unexpected_count,
       g.unexpected_percent, coalesce(ids.sample_trip_ids, '') AS sample_trip_ids{more.format(notes=notes)}
FROM g LEFT JOIN ids ON g.rule_id = ids.rule_id
WHERE NOT g.success"""


def _landed_sql(fault: str, raw: str) -> str:
    return f"""
SELECT '{fault}' AS fault_mode, t.n AS trips_rows, z.n AS zones_rows, t.n AS trips_in_snapshot, z.n AS zones_in_snapshot
FROM (SELECT count(*) AS n FROM ({raw}) r) t, (SELECT count(*) AS n FROM ({q.zones_raw()}) r) z"""


PRICE_PER_DISCOUNT_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount IS NULL OR l_discount = 0 THEN NULL
            ELSE l_extendedprice * 1.0 / l_discount END AS price_per_discount
FROM lineitem
"""


def _mart_tests_sql(batch: str, enriched_sql: str) -> str:
    fct = f"({enriched_sql})"
    dim = f"({q.stg_zones(q.zones_raw())})"
    tests = [
        ("dim_zones_location_id_unique", "unique", "dim_zones", "location_id",
         f"SELECT location_id FROM {dim} d WHERE location_id IS NOT NULL GROUP BY location_id HAVING count(*) > 1"),
        ("dim_zones_location_id_not_null", "not_null", "dim_zones", "location_id",
         f"SELECT * FROM {dim} d WHERE location_id IS NULL"),
        ("fct_trips_trip_id_unique", "unique", "fct_trips", "trip_id",
         f"SELECT trip_id FROM {fct} f WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1"),
        ("fct_trips_trip_id_not_null", "not_null", "fct_trips", "trip_id",
         f"SELECT * FROM {fct} f WHERE trip_id IS NULL"),
        ("fct_trips_pickup_location_id_relationships", "relationships", "fct_trips", "pickup_location_id",
         f"SELECT * FROM {fct} f WHERE pickup_location_id IS NOT NULL AND pickup_location_id NOT IN "
         f"(SELECT location_id FROM {dim} d WHERE location_id IS NOT NULL)"),
        ("fct_trips_dropoff_location_id_relationships", "relationships", "fct_trips", "dropoff_location_id",
         f"SELECT * FROM {fct} f WHERE dropoff_location_id IS NOT NULL AND dropoff_location_id NOT IN "
         f"(SELECT location_id FROM {dim} d WHERE location_id IS NOT NULL)"),
        ("fct_trips_payment_type_accepted_values", "accepted_values", "fct_trips", "payment_type",
         f"SELECT payment_type FROM {fct} f WHERE payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4) "
         f"GROUP BY payment_type"),
        ("fct_trips_fare_amount_not_null", "not_null", "fct_trips", "fare_amount",
         f"SELECT * FROM {fct} f WHERE fare_amount IS NULL OR isnan(fare_amount)"),
        ("int_trips_enriched_trip_id_unique", "unique", "int_trips_enriched", "trip_id",
         f"SELECT trip_id FROM {fct} f WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1"),
        ("int_trips_enriched_trip_id_not_null", "not_null", "int_trips_enriched", "trip_id",
         f"SELECT * FROM {fct} f WHERE trip_id IS NULL"),
        ("int_trips_enriched_trip_duration_minutes_not_null", "not_null", "int_trips_enriched", "trip_duration_minutes",
         f"SELECT * FROM {fct} f WHERE trip_duration_minutes IS NULL OR isnan(trip_duration_minutes)"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{batch}' AS batch, '{tid}' AS test_id, '{kind}' AS kind, '{model}' AS model, "
        f"'{col}' AS \"column\", CAST(count(*) AS BIGINT) AS failures, count(*) = 0 AS passed FROM ({v}) v"
        for tid, kind, model, col, v in tests
    )


def _min_rows_sql(batch: str, name: str) -> str:
    return q.gate_results(batch, q.suite_rules(ORDER_FARE_MAX) + [(7, "batch_min_rows", "min_rows", "", 1.0, MIN_ROWS, None)], name)


def _schema_diff_sql() -> str:
    """Names and types are what the contract and the changes say; the counts come from the rows."""
    changed = {"passenger_count": ("widened", "double"), "payment_type": ("narrowed", "int"), "fare_amount": ("text", "string"),
               "tip_amount": ("incompatible", "boolean"), faults.DRIFT_OLD_NAME: ("missing", None)}
    rows = [(c, *changed.get(c, ("same", t)), t) for c, t in csv.RAW_TRIPS_TYPES.items()] + [(faults.DRIFT_NEW_NAME, "extra", "double", None)]
    text = lambda v: "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"
    return "\nUNION ALL\n".join(
        f"SELECT {k} AS position, '{c}' AS \"column\", '{status}' AS status, {text(expected)} AS expected_type, {text(actual)} AS actual_type, "
        + ("CAST(CASE WHEN count(*) < 0 THEN 0 END AS BIGINT)" if status == "missing" else f"count({c})") + f" AS n_values FROM ({q.schema_drift(q.ORDER_RAW)}) t"
        for k, (c, status, actual, expected) in enumerate(rows))


def _rows_difference_sql() -> str:
    cols = ", ".join(DIFFERENCE_COLUMNS)
    changed = q.negative_values(q.dup_pk(q.ORDER_RAW))
    return f"""
SELECT {cols}, CASE WHEN sum(s) > 0 THEN 'unexpected' ELSE 'missing' END AS side, CAST(abs(sum(s)) AS BIGINT) AS n_rows
FROM (SELECT {cols}, 1 AS s FROM ({changed}) a UNION ALL SELECT {cols}, -1 AS s FROM ({q.ORDER_RAW}) e) u
GROUP BY {cols} HAVING sum(s) <> 0"""


GOLDEN_SQL = """
SELECT CAST(NULL AS BIGINT) AS trip_id, CAST(NULL AS DOUBLE) AS trip_duration_minutes, CAST(NULL AS DOUBLE) AS fare_per_mile,
       'expected' AS side, count(*) AS n_rows
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate = date_trunc('day', l.l_shipdate) AND o.o_orderdate = date_trunc('day', o.o_orderdate)"""


def _run_stages_sql() -> str:
    def of(mode: str, raw: str) -> str:
        gate_sql = q.decided(q.rule_metrics(q.enriched(raw, q.zones_raw()), q.suite_rules(ORDER_FARE_MAX)))
        return f"""
SELECT '{mode}' AS fault_mode, s.position, s.stage,
       CASE s.stage WHEN 'gate' THEN CASE WHEN failed > 0 THEN 'blocked' ELSE 'done' END
                    WHEN 'publish' THEN CASE WHEN failed > 0 THEN 'skipped' ELSE 'done' END ELSE 'done' END AS status,
       CASE WHEN s.stage = 'publish' AND failed > 0 THEN NULL WHEN s.stage = 'land' THEN n.came ELSE landed END AS rows_in,
       CASE WHEN s.stage = 'publish' AND failed > 0 THEN NULL WHEN s.stage = 'gate' AND failed > 0 THEN 0 ELSE landed END AS rows_out,
       CAST(CASE WHEN s.stage = 'gate' THEN failed WHEN s.stage = 'publish' AND failed = 0 THEN 0 END AS INTEGER) AS failed_rules
FROM (SELECT count(*) FILTER (WHERE NOT success) AS failed, max(element_count) AS landed FROM ({gate_sql}) g) x,
     (SELECT count(*) AS came FROM ({q.ORDER_RAW}) o) n,
     (VALUES (0, 'land'), (1, 'build'), (2, 'gate'), (3, 'publish')) s(position, stage)"""

    runs = [of(mode, raw) for mode, raw in (("none", q.ORDER_RAW), ("null_flood", q.null_flood(q.ORDER_RAW)),
                                            ("dup_pk", q.dup_pk(q.ORDER_RAW)), ("negative_values", q.negative_values(q.ORDER_RAW)))]
    # A missing column can't be asked for in SQL: these rows are what the contract says.
    drift = f"""
SELECT 'schema_drift' AS fault_mode, s.position, s.stage, s.status, CASE WHEN s.position = 0 THEN came END AS rows_in,
       CASE WHEN s.position = 0 THEN came END AS rows_out, CAST(NULL AS INTEGER) AS failed_rules
FROM (SELECT count(*) AS came FROM ({q.schema_drift(q.ORDER_RAW)}) o) n,
     (VALUES (0, 'land', 'done'), (1, 'build', 'failed'), (2, 'gate', 'skipped'), (3, 'publish', 'skipped')) s(position, stage, status)"""
    return "\nUNION ALL\n".join(f"SELECT * FROM ({r}) r" for r in [*runs, drift])


def _inferred_types_sql() -> str:
    """Values of each text column that look like a type and can be cast to it."""
    null_texts = ", ".join(f"'{t}'" for t in staging.NULL_TEXTS)
    columns = {
        "trip_id": "CAST(trip_id AS VARCHAR)",
        "passenger_count": "CASE trip_id % 100 WHEN 7 THEN 'NA' WHEN 8 THEN '' ELSE CAST(passenger_count AS VARCHAR) END",
        "parts": "CASE WHEN trip_id % 10 = 3 THEN '2.5' WHEN trip_id % 100 = 9 THEN '1e3' ELSE CAST(passenger_count AS VARCHAR) END",
        "pickup_day": "strftime(pickup_datetime, '%Y-%m-%d')",
        "pickup_time": "CASE WHEN trip_id % 50 = 1 THEN '2024-13-45' ELSE strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') END",
        "payment_type": "CASE trip_id % 25 WHEN 2 THEN 'abc' WHEN 4 THEN 'null' ELSE CAST(payment_type AS VARCHAR) END",
        "nothing": "'NaN'",
    }
    parts = []
    for k, (name, text) in enumerate(columns.items()):
        is_a = lambda kind, pattern: f"count(*) FILTER (WHERE NOT absent AND regexp_matches(v, '{pattern}') AND TRY_CAST(v AS {kind}) IS NOT NULL)"
        counts = f"""SELECT count(*) FILTER (WHERE NOT absent) AS n_values, count(*) FILTER (WHERE absent) AS n_null_texts,
  {is_a('BIGINT', csv.LONG_TEXT)} AS n_long, {is_a('DOUBLE', csv.DOUBLE_TEXT)} AS n_double, {is_a('TIMESTAMP', csv.TIMESTAMP_TEXT)} AS n_timestamp
FROM (SELECT v, v IS NULL OR v IN ({null_texts}) AS absent FROM (SELECT {text} AS v FROM ({q.ORDER_RAW}) o) t) a"""
        parts.append(f"""SELECT {k} AS position, '{name}' AS "column", n_values, n_null_texts, n_long, n_double, n_timestamp,
  CASE WHEN n_values = 0 THEN 'string' WHEN n_long = n_values THEN 'bigint' WHEN n_double = n_values THEN 'double'
       WHEN n_timestamp = n_values THEN 'timestamp_ntz' ELSE 'string' END AS type FROM ({counts}) c""")
    return "\nUNION ALL\n".join(parts)


def _quoting_sql() -> str:
    cases = " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(AWKWARD))
    pick = f"CASE z.location_id % {len(AWKWARD)} {cases} END"
    return q.stg_zones(f"SELECT z.location_id, z.borough, {pick} || z.zone || {pick} AS zone FROM ({q.zones_raw()}) z")


RAISED_MESSAGE_SQL = f""", 'gate blocked {MODEL}: ' || (SELECT count(*) FROM g WHERE NOT success) || ' of ' || (SELECT count(*) FROM g)
    || ' rule(s) failed on ' || (SELECT max(element_count) FROM g) || ' rows ('
    || (SELECT string_agg(rule_id, ', ' ORDER BY rule_index) FROM g WHERE NOT success) || ')' AS message,
    CASE g.rule_id {{notes}} END AS notes"""


def _dispatch_sql() -> str:
    batches = {"none": q.ORDER_RAW, "null_flood": q.null_flood(q.ORDER_RAW), "schema_drift": q.schema_drift(q.ORDER_RAW), "dup_pk": q.dup_pk(q.ORDER_RAW),
               "negative_values": q.negative_values(q.ORDER_RAW), "no_such_fault": f"SELECT * FROM ({q.ORDER_RAW}) o WHERE trip_id IS NULL"}
    distance = lambda mode: faults.DRIFT_NEW_NAME if mode == "schema_drift" else faults.DRIFT_OLD_NAME
    return "\nUNION ALL\n".join(f"""
SELECT '{mode}' AS fault_mode, count(*) AS n_rows, count(DISTINCT trip_id) AS n_ids, count(*) FILTER (WHERE fare_amount IS NULL) AS null_fares,
       count(*) FILTER (WHERE fare_amount < 0) AS negative_fares, count(*) FILTER (WHERE {distance(mode)} < 0) AS negative_distances,
       '{distance(mode)}' AS distance_column FROM ({raw}) r""" for mode, raw in batches.items())


ORACLE: dict[str, str] = {
    "stage_trips": q.stg_trips(q.LINE_RAW),
    "stage_zones": q.stg_zones(q.zones_raw()),
    "cast_half_even": """
SELECT l_orderkey, l_linenumber,
       CAST(l_quantity * 0.5 AS INTEGER) AS qty_half_even,
       CAST(CAST(l_quantity * 0.5 AS VARCHAR) AS INTEGER) AS qty_half_away
FROM lineitem""",
    "safe_divide": PRICE_PER_DISCOUNT_SQL,
    "duration_minutes": f"""
SELECT trip_id, pickup_at, dropoff_at,
       CAST(date_diff('second', pickup_at, dropoff_at) AS DOUBLE) / 60.0 AS trip_duration_minutes
FROM ({q.stg_trips(q.LINE_RAW)}) t""",
    "duration_subsecond": f"""
SELECT event_id,
       date_diff('second', TIMESTAMP '{SUBSECOND_ORIGIN}', ts) AS elapsed_seconds,
       CAST(date_diff('second', TIMESTAMP '{SUBSECOND_ORIGIN}', ts) AS DOUBLE) / 60.0 AS elapsed_minutes
FROM events""",
    "enrich_trips": q.line_enriched(),
    "enrich_orders": q.order_enriched(),
    "enrich_unmatched": q.line_enriched(DROPPED_REGION),
    "fct_trips": q.line_enriched(),
    "dim_zones": q.stg_zones(q.zones_raw()),
    "rule_not_null": q.gate_results(
        PRICE_PER_DISCOUNT_SQL,
        [(0, "price_per_discount_not_null", "not_null", "price_per_discount", 0.98, None, None)]),
    "rule_unique": q.gate_results(q.line_enriched(), [(0, "trip_id_unique", "unique", "trip_id", 1.0, None, None)]),
    "rule_between": q.gate_results(
        "SELECT * FROM customer",
        [(0, "c_acctbal_between", "between", "c_acctbal", 0.98, ACCTBAL_RANGE[0], ACCTBAL_RANGE[1])]),
    "gate_suite": q.gate_results(q.line_enriched(), q.suite_rules(LINE_FARE_MAX), "line_trips")
    + "\nUNION ALL\n"
    + q.gate_results(q.order_enriched(), q.suite_rules(ORDER_FARE_MAX), "order_trips"),
    "gate_suite_reference_bounds": q.gate_results(q.line_enriched(), q.suite_rules(rules.FARE_MAX), "line_trips"),
    "gate_verdict": "\nUNION ALL\n".join([
        _verdict_sql("line_trips", q.line_enriched(), q.suite_rules(LINE_FARE_MAX)),
        _verdict_sql("line_trips_reference_bounds", q.line_enriched(), q.suite_rules(rules.FARE_MAX)),
        _verdict_sql("order_trips", q.order_enriched(), q.suite_rules(ORDER_FARE_MAX)),
    ]),
    "gate_samples": q.offender_samples(q.line_enriched(), q.suite_rules(rules.FARE_MAX)),
    "fault_null_flood": q.null_flood(q.ORDER_RAW),
    "fault_dup_pk": q.dup_pk(q.ORDER_RAW),
    "fault_negative_values": q.negative_values(q.ORDER_RAW),
    "fault_schema_drift": q.schema_drift(q.ORDER_RAW),
    "gate_after_null_flood": _gate_after_sql(q.null_flood(q.ORDER_RAW)),
    "gate_after_dup_pk": _gate_after_sql(q.dup_pk(q.ORDER_RAW)),
    "gate_after_negative_values": _gate_after_sql(q.negative_values(q.ORDER_RAW)),
    "samples_after_null_flood": q.offender_samples(
        q.enriched(q.null_flood(q.ORDER_RAW), q.zones_raw()), q.suite_rules(ORDER_FARE_MAX)),
    "samples_after_dup_pk": q.offender_samples(
        q.enriched(q.dup_pk(q.ORDER_RAW), q.zones_raw()), q.suite_rules(ORDER_FARE_MAX)),
    "samples_after_negative_values": q.offender_samples(
        q.enriched(q.negative_values(q.ORDER_RAW), q.zones_raw()), q.suite_rules(ORDER_FARE_MAX)),
    "test_unique": f"""
SELECT trip_id, count(*) AS n_rows FROM ({q.line_enriched()}) f
WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1""",
    "test_not_null": f"SELECT * FROM ({PRICE_PER_DISCOUNT_SQL}) p WHERE price_per_discount IS NULL",
    "test_relationships": f"""
SELECT f.trip_id, f.pickup_location_id FROM ({q.line_enriched()}) f
WHERE f.pickup_location_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM ({q.stg_zones(q.zones_raw(DROPPED_REGION))}) d
                  WHERE d.location_id = f.pickup_location_id)""",
    "test_accepted_values": """
SELECT o_orderstatus, count(*) AS n_rows FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""",
    "mart_tests": _mart_tests_sql("line_trips", q.line_enriched())
    + "\nUNION ALL\n" + _mart_tests_sql("order_trips", q.order_enriched()),
    "land_manifest": _landed_sql("none", q.ORDER_RAW),
    "land_dup_pk": _landed_sql("dup_pk", q.dup_pk(q.ORDER_RAW)),
    "land_interleaved": q.stg_trips(q.ORDER_RAW),
    "raw_table_by_name": q.stg_trips(q.ORDER_RAW),
    "land_twice": f"""
SELECT count(*) AS visible_rows, CAST(2 AS BIGINT) AS snapshots, 2 * count(*) AS rows_written
FROM ({q.ORDER_RAW}) t""",
    "csv_roundtrip": q.stg_trips(q.ORDER_RAW),
    "csv_zones_roundtrip": q.stg_zones(q.zones_raw()),
    "publish_clean": q.order_enriched(),
    "publish_blocked": f"""
SELECT CASE WHEN failed > 0 THEN 1 ELSE 0 END AS outcome, CASE WHEN failed > 0 THEN 'blocked' ELSE 'published' END AS outcome_name,
       rows AS rows_landed, rows AS rows_checked, CAST(failed AS INTEGER) AS failed_rules, failed = 0 AS published, failed = 0 AS marts_exist
FROM (SELECT count(*) FILTER (WHERE NOT success) AS failed, max(element_count) AS rows
      FROM ({q.decided(q.rule_metrics(q.line_enriched(), q.suite_rules(LINE_FARE_MAX)))}) g) x""",
    "run_outcomes": "\nUNION ALL\n".join(
        [_outcome_sql(mode, raw) for mode, raw in (
            ("none", q.ORDER_RAW),
            ("null_flood", q.null_flood(q.ORDER_RAW)),
            ("dup_pk", q.dup_pk(q.ORDER_RAW)),
            ("negative_values", q.negative_values(q.ORDER_RAW)),
        )]
        # A missing column cannot be asked for in SQL: this row is what the contract says.
        + [f"""SELECT 'schema_drift' AS fault_mode, 2 AS outcome, count(*) AS rows_landed,
       CAST(NULL AS BIGINT) AS rows_checked, CAST(NULL AS INTEGER) AS failed_rules, FALSE AS marts_exist
FROM ({q.schema_drift(q.ORDER_RAW)}) t"""]),
    "run_outcomes_csv": "\nUNION ALL\n".join(f"SELECT * FROM ({_csv_outcome_sql(label)}) c" for label in CSV_CASES),
    "enrich_shuffled": q.line_enriched(),
    "fault_hot_key": f"""
SELECT count(*) AS rows, CAST(floor(CAST(count(*) AS DOUBLE) * CAST(0.35 AS DOUBLE)) AS BIGINT) AS nulled,
       count(DISTINCT pickup_datetime) AS pickup_times, count(DISTINCT trip_id) AS trip_ids,
       CAST(sum(passenger_count) AS BIGINT) AS passengers
FROM ({q.LINE_RAW}) t""",
    "stream_gate": q.order_enriched(),
    "alert_failures": _alert_sql(rules.FARE_MAX),
    "alert_payload": _alert_sql(rules.FARE_MAX, f", '{CHECKED_AT.isoformat()}' AS checked_at, "
                                "CASE g.rule_id {{notes}} END AS notes".replace("{{", "{").replace("}}", "}")),
    "alert_sink": _alert_sql(LINE_FARE_MAX, ", CASE g.rule_id {notes} END AS notes"),
    "csv_mixed_headers": q.stg_trips(q.ORDER_RAW),
    "csv_quoting": _quoting_sql(),
    "csv_inferred_types": _inferred_types_sql(),
    "gate_min_rows": _min_rows_sql(q.order_enriched(), "order_trips") + "\nUNION ALL\n"
    + _min_rows_sql(f"SELECT * FROM ({q.order_enriched()}) e WHERE payment_type = {NO_SUCH_PAYMENT}", "lost"),
    "schema_diff": _schema_diff_sql(),
    "rows_difference": _rows_difference_sql(),
    "golden_rows": GOLDEN_SQL,
    "run_stages": _run_stages_sql(),
    "orphan_keys": f"""
SELECT f.dropoff_location_id, count(*) AS n_rows FROM ({q.line_enriched()}) f
WHERE f.dropoff_location_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM ({q.stg_zones(q.zones_raw(DROPPED_REGION))}) d WHERE d.location_id = f.dropoff_location_id)
GROUP BY f.dropoff_location_id""",
    "gate_raises": _alert_sql(LINE_FARE_MAX, RAISED_MESSAGE_SQL),
    "samples_without_id": f"SELECT * REPLACE ('' AS sample_trip_ids) FROM ({_alert_sql(rules.FARE_MAX)}) a",
    "fault_dispatch": _dispatch_sql(),
    "lake_states": f"""
SELECT 'empty' AS state, CAST(NULL AS BIGINT) AS n_rows, 'raw.trips has no committed snapshot under <root>' AS error
UNION ALL SELECT s.state, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error
FROM ({q.ORDER_RAW}) o, (VALUES ('landed'), ('written')) s(state) GROUP BY s.state""",
}
