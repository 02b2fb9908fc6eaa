"""Spark session helpers.

Every job in this package is written to be independent of the session time zone (all
timestamps are ``timestamp_ntz`` and all arithmetic on them uses ``timestampdiff`` /
``timestampadd``), but a session we build ourselves still pins UTC and ANSI mode so that
anything a user adds on top behaves like the SQL oracle.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings a session built by this package always carries.
PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

LAKE_CONF_KEY = "auditlane.lake.root"


def build_session(
    master: str = "local[*]",
    app_name: str = "auditlane",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the pinned settings applied."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(PINNED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Connect) session that has none."""
    try:
        return spark.sparkContext
    except PySparkException:  # Spark Connect: no context, but configuration is readable
        return None


def _runs_in_this_process(spark: SparkSession) -> bool:
    """Whether executors are threads of the driver, so that its folders are theirs."""
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file system);
    only when nothing is configured -- local runs and tests -- do we create a private one.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
                  else spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if not _runs_in_this_process(spark):
        # Executors would each write to their own disk: refuse instead of losing data.
        raise RuntimeError(
            "no shared folder configured: set spark.checkpoint.dir (or auditlane.lake.root) "
            "to a location every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="auditlane-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    return local


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def lake_root(spark: SparkSession) -> str:
    """Root of the lake (raw snapshots, staging freezes, marts, results, alerts).

    ``auditlane.lake.root`` wins; otherwise a folder beside the checkpoint data of all
    applications: the configured ``spark.checkpoint.dir`` itself, without the part that Spark
    adds for each application, so every kind of session finds the same lake.
    """
    configured = spark.conf.get(LAKE_CONF_KEY, None)
    if configured:
        return configured.rstrip("/")
    sc = _context(spark)
    shared = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
              else spark.conf.get("spark.checkpoint.dir", None))
    return f"{(shared or checkpoint_root(spark)).rstrip('/')}/auditlane-lake"


def ensure_lake_root(spark: SparkSession, path: str | None = None) -> str:
    """Pin the lake root for this session; without a path, a temporary one for local masters only."""
    if path is None:
        if not _runs_in_this_process(spark):
            raise RuntimeError("name a lake root that every executor can reach")
        path = os.path.join(tempfile.mkdtemp(prefix="auditlane-lake-"), "lake")
    spark.conf.set(LAKE_CONF_KEY, path)
    return path


def literal_frame(spark: SparkSession, rows, schema) -> "DataFrame":
    """A small DataFrame built from literals on the JVM side, in a single partition.

    Used where a write must produce exactly one file (a commit record naming several
    tables) and for empty frames of a given schema: unlike ``createDataFrame(list)``, which
    spreads rows over ``defaultParallelism`` slices, all rows land in one partition, and no
    Python worker is involved.  ``rows`` are tuples (or Rows) in field order; timestamps are
    passed as text so that no time zone is applied on the way in.
    """
    from datetime import datetime

    from pyspark.sql import functions as F
    from pyspark.sql.types import DataType, StructType, TimestampNTZType

    struct = schema if isinstance(schema, StructType) else DataType.fromDDL(schema)

    def lit(value, field):
        if value is None:
            return F.lit(None).cast(field.dataType)
        if isinstance(value, datetime):
            text = value.replace(tzinfo=None).isoformat(sep=" ")
            return F.lit(text).cast(field.dataType if isinstance(field.dataType, TimestampNTZType) else "timestamp_ntz")
        return F.lit(value).cast(field.dataType)

    structs = [F.struct(*[lit(v, f).alias(f.name) for v, f in zip(tuple(r), struct.fields)]) for r in rows]
    if not structs:  # keep the schema, produce no row
        structs = [F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields])]
        return spark.range(0, 0, 1, 1).select(F.inline(F.array(*structs)))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
