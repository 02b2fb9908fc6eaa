"""Result and alert sinks.

* gate results: appended as Parquet rows (one per rule per run) under ``results/gate_results``;
* alerts: one JSON document per blocked run appended under ``alerts``; the latest one is the
  alert with the greatest ``checked_at``.

Both are written by Spark to the lake (any Hadoop file system).  No network side effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from auditlane.sources.lake import Lake


# Fields of an alert document; sample ids are read as text, whatever their type.
ALERT_SCHEMA = (
    "source string, gate string, model string, suite_name string, checked_at string, success boolean, row_count long, "
    "failed_expectation_count long, failures array<struct<rule_index: int, expectation_type: string, column: string, "
    "unexpected_count: long, unexpected_percent: double, sample_trip_ids: array<string>, notes: string>>"
)


class ResultsSink:
    def __init__(self, lake: Lake, name: str = "gate_results"):
        self.path = f"{lake.root}/results/{name}"

    def write(self, results: DataFrame) -> None:
        results.write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


class AlertSink:
    def __init__(self, lake: Lake, name: str = "alerts"):
        self.path = f"{lake.root}/{name}"

    def send(self, spark: SparkSession, payload_json: str) -> str:
        spark.createDataFrame([(payload_json,)], "value string").write.mode("append").text(self.path)
        return self.path

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(ALERT_SCHEMA).json(self.path)

    def last(self, spark: SparkSession) -> dict | None:
        """The alert of greatest ``checked_at``: one aggregate, every task keeps its greatest."""
        try:
            alerts = self.read(spark)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return None  # nothing written yet
        found = alerts.agg(F.max_by(F.struct(*alerts.columns), "checked_at").alias("a")).first()["a"]
        return None if found is None else found.asDict(recursive=True)
