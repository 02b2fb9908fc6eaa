"""Snapshots as plain Parquet folders, current ones as tables of Spark's catalog.

Layout under the lake root (a path as Hadoop reads it: ``hdfs:``, ``s3a:``, ``file:``, or without
a scheme on the default file system)::

    <namespace>/<table>/snapshot_id=<id>/part-*.parquet

A snapshot is one Spark write into a folder of its own, with a random id.  Which one is current is
the location of the table ``<prefix><namespace>.<table>`` in Spark's catalog (``sources.catalog``);
committing moves it.  So a half-written snapshot is invisible, a blocked run leaves the previous
one current, landing twice replaces the visible rows, and earlier snapshots stay readable by
id.  With a shared metastore all applications see the same tables; Spark's default in-memory
catalog lasts as long as its application, the folders stay.  Tables committed in one call are moved
one after the other, in the order given.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from auditlane.session import lake_root
from auditlane.sources import catalog
from auditlane.sources.catalog import TableNotFound

__all__ = ["Lake", "Snapshot", "TableNotFound"]


@dataclass(frozen=True)
class Snapshot:
    namespace: str
    table: str
    path: str
    snapshot_id: int | None
    schema: StructType
    row_count: int | None = None  # as observed by the write; not known of snapshots looked up

    def named(self, namespace: str, table: str) -> Snapshot:
        """The same data as another table's snapshot, not yet committed."""
        return replace(self, namespace=namespace, table=table)


def _id_of(path: str) -> int | None:
    found = re.search(r"/snapshot_id=(\d+)/?$", path)
    return int(found[1]) if found else None


class Lake:
    """A root folder, and a prefix of its databases.

    The lake of the session's own root has no prefix (``raw.trips``, ``marts.fct_trips``); one
    opened by its path gets a prefix made from it, so that lakes don't share tables.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str | None = None):
        self.spark = spark
        self.root = (root or lake_root(spark)).rstrip("/")
        self.prefix = prefix if prefix is not None else "" if root is None else f"lake_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_"

    def database(self, namespace: str) -> str:
        return f"{self.prefix}{namespace}"

    def table_path(self, namespace: str, table: str) -> str:
        return f"{self.root}/{namespace}/{table}"

    # -- write --------------------------------------------------------------------------
    def write_snapshot(self, namespace: str, table: str, df: DataFrame) -> Snapshot:
        """Write ``df`` as a new, not yet visible snapshot; the row count is observed in
        the same job as the write (no second scan)."""
        snapshot_id = uuid.uuid4().int >> 66
        path = f"{self.table_path(namespace, table)}/snapshot_id={snapshot_id}"
        obs = Observation(f"rows_{table}_{snapshot_id}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
        return Snapshot(namespace, table, path, snapshot_id, df.schema, int(obs.get.get("rows", 0)))

    def write_snapshots(self, items: list[tuple[str, str, DataFrame]]) -> list[Snapshot]:
        """Write several independent snapshots as concurrent Spark jobs (one thread each),
        so a small table's job overlaps a large one's instead of queueing behind it."""
        if len(items) <= 1:
            return [self.write_snapshot(*item) for item in items]
        # Inherit the caller's local properties (job group, scheduler pool) in the workers.
        write = inheritable_thread_target(self.spark)(lambda item: self.write_snapshot(*item))
        with ThreadPoolExecutor(max_workers=len(items)) as pool:
            return list(pool.map(write, items))

    def commit(self, *snaps: Snapshot) -> tuple[Snapshot, ...]:
        """Make ``snaps`` current, by moving their tables' locations in the order given."""
        for s in snaps:
            catalog.point(self.spark, self.database(s.namespace), s.table, s.path, s.schema, f"{self.root}/{s.namespace}")
        return snaps

    def write(self, namespace: str, table: str, df: DataFrame) -> Snapshot:
        """Write and commit in one step."""
        return self.commit(self.write_snapshot(namespace, table, df))[0]

    # -- read ---------------------------------------------------------------------------
    def history(self, namespace: str, table: str) -> DataFrame:
        """snapshot_id and row_count of every snapshot that was written under this table's own name."""
        return (self.spark.read.parquet(self.table_path(namespace, table))
                .groupBy(F.col("snapshot_id").cast("long").alias("snapshot_id")).agg(F.count(F.lit(1)).alias("row_count")))

    def _current_path(self, namespace: str, table: str) -> str | None:
        return catalog.location(self.spark, self.database(namespace), table)

    def snapshot(self, namespace: str, table: str, snapshot_id: int | None = None) -> Snapshot | None:
        """The snapshot of that id, or the current one; None when there is none."""
        try:
            schema = self.read(namespace, table, snapshot_id).schema
        except TableNotFound:
            return None
        path = self._current_path(namespace, table)
        if snapshot_id is not None and (path is None or _id_of(path) != snapshot_id):
            path = f"{self.table_path(namespace, table)}/snapshot_id={snapshot_id}"
        return Snapshot(namespace, table, path, _id_of(path), schema)

    def current_snapshot_id(self, namespace: str, table: str) -> int | None:
        path = self._current_path(namespace, table)
        return None if path is None else _id_of(path)

    def exists(self, namespace: str, table: str) -> bool:
        return catalog.exists(self.spark, self.database(namespace), table)

    def read(self, namespace: str, table: str, snapshot_id: int | None = None) -> DataFrame:
        """The current rows, by the table's name, or those of one snapshot, from its folder."""
        if snapshot_id is None or snapshot_id == self.current_snapshot_id(namespace, table):
            if not self.exists(namespace, table):
                raise TableNotFound(f"{namespace}.{table} has no committed snapshot under {self.root}")
            return self.spark.table(catalog.full_name(self.database(namespace), table))
        try:
            return self.spark.read.parquet(f"{self.table_path(namespace, table)}/snapshot_id={snapshot_id}")
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            raise TableNotFound(f"{namespace}.{table} has no snapshot {snapshot_id} under {self.root}") from exc
