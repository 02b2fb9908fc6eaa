"""Tables by name, through Spark's own catalog (in-memory, or a shared metastore on a cluster).

A table of ours is an external Parquet table whose location is one written folder, with a
property that says so.  Publishing new data is ``ALTER TABLE ... SET LOCATION``: readers that
resolve the name afterwards see the new folder, readers that already hold a DataFrame keep the
old one, and no data file is touched.  A table that doesn't carry our property (a managed table,
someone else's external one, a view) is never altered or dropped; pointing at it raises ``NotOurs``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The property that marks our tables.
OWNER_PROPERTY, OWNER = "auditlane.pointer", "true"


class TableNotFound(LookupError):
    """No such table, or no such snapshot of it."""


class NotOurs(RuntimeError):
    """A table of that name exists that this package did not make."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def full_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(full_name(database, table))


def is_ours(spark: SparkSession, database: str, table: str) -> bool:
    """Whether the table is an external one that carries our property (commands only, no job)."""
    name = full_name(database, table)
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        return False
    return (OWNER_PROPERTY, OWNER) in {(r["key"], r["value"]) for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def location(spark: SparkSession, database: str, table: str) -> str | None:
    """Where the table's data is; None when there is no such table."""
    if not exists(spark, database, table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name(database, table)}").collect()
    return next((r["data_type"] for r in described if r["col_name"] == "Location"), None)


def _create(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {_text(path)} "
              f"TBLPROPERTIES ({_text(OWNER_PROPERTY)} = {_text(OWNER)})")


def point(spark: SparkSession, database: str, table: str, path: str, schema: StructType, database_path: str | None = None) -> str:
    """Make ``database.table`` show the Parquet folder ``path``; returns the table's name."""
    name = full_name(database, table)
    at = f" LOCATION {_text(database_path)}" if database_path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{at}")
    if not exists(spark, database, table):
        _create(spark, name, path, schema)
    elif not is_ours(spark, database, table):
        raise NotOurs(f"{database}.{table} exists and was not made here; it is left as it is")
    elif spark.table(name).schema.simpleString() == schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
    else:  # other columns: only a new entry can show them; an external table's files stay
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, path, schema)
    spark.catalog.refreshTable(name)
    return f"{database}.{table}"


def register(lake, namespace: str, table: str, snapshot_id: int | None = None) -> str:
    """Show a snapshot of a lake also as ``namespace.table``, without the lake's own prefix."""
    found = lake.snapshot(namespace, table, snapshot_id)
    if found is None:
        raise TableNotFound(f"{namespace}.{table} has no snapshot under {lake.root}")
    return point(lake.spark, namespace, table, found.path, found.schema)


def table(spark: SparkSession, name: str) -> DataFrame:
    """``spark.table(name)`` with a clear error when the table was never built."""
    try:
        return spark.table(name)
    except AnalysisException as exc:
        if "TABLE_OR_VIEW_NOT_FOUND" in str(exc):
            raise TableNotFound(
                f"{name} is not built yet: run the staging and enrichment steps first"
            ) from exc
        raise
