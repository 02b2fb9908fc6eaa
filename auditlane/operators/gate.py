"""The quality gate: evaluate a rule suite over a whole batch, sample offenders, alert.

Plan shape (see ``README.md`` for the scale argument):

* row rules (not-null, between) -> one global aggregate; each task emits one partial row,
  so no rows are shuffled at all;
* each unique rule -> ``groupBy(key).count()`` with map-side partial aggregation (a hot
  key collapses to one row per task before the shuffle), then a global sum;
* the per-rule rows are unioned, so a single action computes every rule;
* offender ids are sampled only for failed rules, all in one scan, with at most ``k`` rows
  per rule and task left before the ranking shuffle.

Only the per-rule result rows (one per rule) and at most ``k`` ids per failed rule ever
reach the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from auditlane.functions.exprs import is_missing, percent_of
from auditlane.operators.rules import Rule, TableRule, Unique
from auditlane.session import literal_frame

# The alert header, the per-failure sample size, and below the payload's key names
# (``expectation_type``, ``sample_trip_ids``, ...), which readers of alerts rely on.
ALERT_SOURCE = "auditlane.gate"
GATE_NAME = "column_rule_gate"
SAMPLE_IDS_PER_FAILURE = 10

METRIC_SCHEMA = StructType(
    [
        StructField("rule_index", IntegerType(), False),
        StructField("rule_id", StringType(), False),
        StructField("rule_type", StringType(), False),
        StructField("column", StringType(), False),
        StructField("mostly", DoubleType(), False),
        StructField("column_present", BooleanType(), False),
        StructField("element_count", LongType(), False),
        StructField("missing_count", LongType(), False),
        StructField("evaluated_count", LongType(), False),
        StructField("unexpected_count", LongType(), False),
        StructField("notes", StringType(), False),
    ]
)

RESULT_COLUMNS = (
    "run_id",
    "model",
    "suite",
    "rule_index",
    "rule_id",
    "rule_type",
    "column",
    "mostly",
    "element_count",
    "missing_count",
    "evaluated_count",
    "unexpected_count",
    "unexpected_percent",
    "success",
    "notes",
    "checked_at",
)

def sample_schema(id_type: DataType) -> StructType:
    """Sampled ids keep the type that the id column has."""
    return StructType(
        [
            StructField("rule_id", StringType(), False),
            StructField("rank", IntegerType(), False),
            StructField("row_id", id_type, True),
        ]
    )


def _metric(rule: Rule, index: int, present: bool, n: Column, m: Column, e: Column, u: Column) -> Column:
    return F.struct(
        F.lit(index).cast("int").alias("rule_index"),
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.kind).alias("rule_type"),
        F.lit(rule.column).alias("column"),
        F.lit(float(rule.mostly)).alias("mostly"),
        F.lit(present).alias("column_present"),
        n.cast("long").alias("element_count"),
        m.cast("long").alias("missing_count"),
        e.cast("long").alias("evaluated_count"),
        u.cast("long").alias("unexpected_count"),
        F.lit(rule.notes).alias("notes"),
    )


def rule_metrics(df: DataFrame, rules: tuple[Rule, ...] | list[Rule]) -> DataFrame:
    """One row per rule with raw counts (schema ``METRIC_SCHEMA``); nothing decided yet."""
    types = {f.name: f.dataType for f in df.schema.fields}
    indexed = list(enumerate(rules))
    table_rules = [(i, r) for i, r in indexed if isinstance(r, TableRule)]
    indexed = [(i, r) for i, r in indexed if not isinstance(r, TableRule)]
    row_rules = [(i, r) for i, r in indexed if r.column in types and not isinstance(r, Unique)]
    absent = [(i, r) for i, r in indexed if r.column not in types]
    key_rules = [(i, r) for i, r in indexed if r.column in types and isinstance(r, Unique)]

    parts: list[DataFrame] = []
    if row_rules or absent or table_rules:
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, r in row_rules:
            dt = types[r.column]
            aggs += [
                F.count_if(is_missing(r.column, dt)).alias(f"m{i}"),
                F.count_if(r.evaluated(dt)).alias(f"e{i}"),
                F.count_if(r.violation(dt)).alias(f"u{i}"),
            ]
        totals = df.agg(*aggs)
        zero = F.lit(0)
        structs = [_metric(r, i, True, F.col("n"), F.col(f"m{i}"), F.col(f"e{i}"), F.col(f"u{i}"))
                   for i, r in row_rules]
        structs += [_metric(r, i, False, F.col("n"), zero, zero, zero) for i, r in absent]
        structs += [_metric(r, i, True, F.col("n"), zero, F.lit(1), F.when(r.satisfied(F.col("n")), 0).otherwise(1)) for i, r in table_rules]
        parts.append(totals.select(F.inline(F.array(*structs))))

    for i, r in key_rules:
        dt = types[r.column]
        groups = df.groupBy(F.col(r.column).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
        miss = is_missing("__key", dt)
        rows = F.col("__rows")
        sums = groups.agg(
            F.coalesce(F.sum(rows), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(miss, rows)), F.lit(0)).alias("m"),
            F.coalesce(F.sum(F.when(~miss, rows)), F.lit(0)).alias("e"),
            F.coalesce(F.sum(F.when(~miss & (rows > 1), rows)), F.lit(0)).alias("u"),
        )
        parts.append(
            sums.select(F.inline(F.array(
                _metric(r, i, True, F.col("n"), F.col("m"), F.col("e"), F.col("u"))
            )))
        )

    if not parts:
        return literal_frame(df.sparkSession, [], METRIC_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def decide(metrics: DataFrame) -> DataFrame:
    """Add ``unexpected_percent`` and ``success`` to rule metrics."""
    e, u = F.col("evaluated_count"), F.col("unexpected_count")
    passes = F.when(e == 0, F.lit(True)).otherwise(
        (e - u).cast("double") / e.cast("double") >= F.col("mostly")
    )
    return metrics.withColumns(
        {
            "unexpected_percent": percent_of(u, e),
            "success": F.col("column_present") & passes,
        }
    )


def evaluate(
    df: DataFrame,
    rules: tuple[Rule, ...] | list[Rule],
    *,
    model: str,
    suite: str,
    run_id: str | None = None,
    checked_at: datetime | None = None,
) -> DataFrame:
    """``gate_results``: one row per rule, tagged with the run (schema ``RESULT_COLUMNS``)."""
    run_id = run_id or uuid.uuid4().hex
    checked_at = (checked_at or datetime.now(UTC)).replace(tzinfo=None)
    return (
        decide(rule_metrics(df, rules))
        .withColumns(
            {
                "run_id": F.lit(run_id),
                "model": F.lit(model),
                "suite": F.lit(suite),
                "checked_at": F.lit(checked_at).cast(TimestampNTZType()),
            }
        )
        .select(*RESULT_COLUMNS)
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: overall success, rows checked, number of failed rules."""
    return results.agg(
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
        F.coalesce(F.max("element_count"), F.lit(0)).cast("long").alias("row_count"),
        F.count_if(~F.col("success")).cast("long").alias("failed_expectation_count"),
    )


def offender_samples(
    df: DataFrame,
    rules: tuple[Rule, ...] | list[Rule],
    rule_ids: list[str] | None = None,
    *,
    id_col: str = "trip_id",
    k: int = SAMPLE_IDS_PER_FAILURE,
) -> DataFrame:
    """Up to ``k`` offending ids per rule (smallest first), for the given rules only.

    Each rule scans the id and its own column, with its violation pushed to the files' statistics, and each
    task keeps its ``k`` smallest ids in a bounded heap: nothing is sorted, and no more than ``k`` rows a rule
    leave the scan.  A uniqueness rule on the id scans the id alone: ids are counted (combined before the
    shuffle, which carries nothing else) and the smallest of those met twice are kept in the same way.  One on
    another column (none in the trip suite) adds a join with its duplicated keys.
    """
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    wanted = [r for r in rules if (rule_ids is None or r.rule_id in rule_ids) and r.column in types and not isinstance(r, TableRule)]
    if id_col not in types or not wanted or k <= 0:
        return literal_frame(spark, [], sample_schema(types.get(id_col, LongType())))

    row_id = F.col(id_col).alias("row_id")
    smallest = F.col("row_id").asc_nulls_last()

    def met_twice(column: str) -> DataFrame:
        counted = df.groupBy(F.col(column).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
        return counted.where(~is_missing("__key", types[column]) & (F.col("__rows") > 1)).select("__key")

    def offending(rule: Rule) -> DataFrame:
        if not isinstance(rule, Unique):
            return df.where(rule.violation(types[rule.column])).select(row_id)
        keys = met_twice(rule.column)
        if rule.column == id_col:
            return keys.select(F.col("__key").alias("row_id"))
        return df.join(keys, df[rule.column] == keys["__key"], "left_semi").select(row_id)

    tops = [offending(r).orderBy(smallest).limit(k).select(F.lit(r.rule_id).alias("rule_id"), "row_id") for r in wanted]
    # At most k rows a rule are left to number.
    numbered = F.row_number().over(Window.partitionBy("rule_id").orderBy(smallest)).cast("int")
    return reduce(DataFrame.unionByName, tops).select("rule_id", numbered.alias("rank"), "row_id")


def build_alert(
    results: DataFrame,
    samples: DataFrame,
    *,
    source: str = ALERT_SOURCE,
    gate: str = GATE_NAME,
) -> DataFrame:
    """One-row alert: header fields, the failed rules with their sample ids, and the JSON text."""
    id_type = samples.schema["row_id"].dataType
    ids = samples.groupBy("rule_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "row_id"))).alias("__s")
    ).select("rule_id", F.transform("__s", lambda s: s["row_id"]).alias("sample_trip_ids"))
    failure = F.struct(
        F.col("rule_index"),
        F.col("rule_type").alias("expectation_type"),
        F.col("column"),
        F.col("unexpected_count"),
        F.col("unexpected_percent"),
        F.coalesce(F.col("sample_trip_ids"), F.array().cast(ArrayType(id_type))).alias("sample_trip_ids"),
        F.col("notes"),
    )
    # One aggregate over (one row per rule) x (its samples): header fields and the failed
    # rules, ordered by rule_index (collect_list skips the NULLs of passing rules).
    alert = results.join(ids, "rule_id", "left").agg(
        F.first("model").alias("model"),
        F.first("suite").alias("suite_name"),
        F.max("checked_at").alias("checked_at"),
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
        F.coalesce(F.max("element_count"), F.lit(0)).cast("long").alias("row_count"),
        F.sort_array(F.collect_list(F.when(~F.col("success"), failure))).alias("failures"),
    )
    alert = alert.select(
        F.lit(source).alias("source"),
        F.lit(gate).alias("gate"),
        "model",
        "suite_name",
        "checked_at",
        "success",
        "row_count",
        F.size("failures").cast("long").alias("failed_expectation_count"),
        "failures",
    )
    return alert.withColumn("payload_json", F.to_json(F.struct(*alert.columns)))


class GateBlocked(RuntimeError):
    """The gate refused the batch; ``payload`` is the alert that was dispatched."""

    def __init__(self, message: str, payload: dict[str, Any]):
        super().__init__(message)
        self.payload = payload


@dataclass
class GateReport:
    run_id: str
    model: str
    suite: str
    checked_at: datetime
    success: bool
    row_count: int
    results: list[dict[str, Any]] = field(default_factory=list)
    payload: dict[str, Any] | None = None

    @property
    def failures(self) -> list[dict[str, Any]]:
        return [r for r in self.results if not r["success"]]


def run_gate(
    df: DataFrame,
    rules: tuple[Rule, ...] | list[Rule],
    *,
    model: str,
    suite: str,
    id_col: str = "trip_id",
    sample_size: int = SAMPLE_IDS_PER_FAILURE,
    results_sink: Any = None,
    alert_sink: Any = None,
    raise_on_failure: bool = True,
    run_id: str | None = None,
) -> GateReport:
    """Evaluate ``rules`` on ``df``; on failure persist results, alert, then raise.

    ``df`` should be a frozen batch (a written table), so that what is audited is exactly
    what is published afterwards.
    """
    spark: SparkSession = df.sparkSession
    run_id = run_id or uuid.uuid4().hex
    checked_at = datetime.now(UTC).replace(tzinfo=None)
    results_df = evaluate(df, rules, model=model, suite=suite, run_id=run_id, checked_at=checked_at)
    rows: list[Row] = sorted(results_df.collect(), key=lambda r: r["rule_index"])
    frozen = spark.createDataFrame(rows, results_df.schema)
    success = all(r["success"] for r in rows)
    row_count = rows[0]["element_count"] if rows else df.count()
    report = GateReport(
        run_id=run_id,
        model=model,
        suite=suite,
        checked_at=checked_at,
        success=success,
        row_count=int(row_count),
        results=[r.asDict() for r in rows],
    )
    if results_sink is not None:
        results_sink.write(frozen)
    if success:
        return report

    failed_ids = [r["rule_id"] for r in rows if not r["success"]]
    samples = offender_samples(df, rules, failed_ids, id_col=id_col, k=sample_size)
    alert_row = build_alert(frozen, samples).collect()[0]
    payload = json.loads(alert_row["payload_json"])
    report.payload = payload
    if alert_sink is not None:
        alert_sink.send(spark, alert_row["payload_json"])
    if raise_on_failure:
        raise GateBlocked(
            f"gate blocked {model}: {len(failed_ids)} of {len(rows)} rule(s) failed "
            f"on {row_count} rows ({', '.join(failed_ids)})",
            payload,
        )
    return report
