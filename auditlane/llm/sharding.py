"""Sharding by jump consistent hashing.

A row's shard is a function of its key and the number of shards alone: no ring, no table.
Going from n to n + 1 shards moves about 1/(n + 1) of the keys, all of them into the new
shard.  The recurrence (Lamping and Veach, 2014) runs on whole Arrow batches in numpy; it
needs unsigned 64-bit arithmetic that wraps, which SQL integers refuse to do.

Places inside a shard are numbered without a global or per-shard sort.  Rows that are alike in
everything returned (id, text hash, size) are counted first; what differs falls into
buckets of a bounded mean size by its content, bucket sums give each bucket its first slot, and only a
bucket is sorted.  So slots depend on the rows alone, not on how they lie in files, and rows that
repeat, however often, are one row until the end, where long runs are dealt out in stretches.

Defined cases: a null key is a key like any other; rows that repeat a key share its shard
and get slots of their own; a null or empty text has no bytes; very long texts are only measured and hashed; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

# Fixed values of the published recurrence.
MULTIPLIER = np.uint64(2862933555777941757)
SHIFT = np.uint64(33)

DEFAULT_SHARDS = 24
ROW_OVERHEAD_BYTES = 8
BUCKET_ROWS = 65_536


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, by the published recurrence."""
    if shards < 1:
        raise ValueError(f"shards must be positive, got {shards}")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            state[live] = state[live] * MULTIPLIER + np.uint64(1)
            draw = (state[live] >> SHIFT).astype(np.float64) + 1.0
            jump = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
            inside = jump < shards
            live = live[inside]
            shard[live] = jump[inside]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard (0 to shards - 1) of a key of any atomic type; equal keys, equal shards."""

    @F.pandas_udf("int")
    def assign(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashes.to_numpy(dtype=np.int64).view(np.uint64), shards))

    return assign(F.xxhash64(key.cast("string")))


def number_slots(scratch: Scratch, rows: DataFrame, shard: str, order: list[str], shards: int) -> DataFrame:
    """Add `slot`: 0, 1, 2, ... without gaps inside each shard.

    `rows` has `n`, how many rows are alike in the columns of `order`, which decide everything: a bucket is a
    hash of them, so no slot depends on how the input lies in files.
    """
    counts = {r[shard]: r["n"] for r in rows.groupBy(shard).agg(F.sum("n").alias("n")).collect()}
    buckets = F.element_at(F.lit([max(1, -(-counts.get(k, 0) // BUCKET_ROWS)) for k in range(shards)]), F.col(shard) + 1)
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets).cast("int"))
    in_order = Window.partitionBy(shard).orderBy("_bucket")
    firsts = placed.groupBy(shard, "_bucket").agg(F.sum("n").alias("_n")).withColumn("_first", F.sum("_n").over(in_order) - F.col("_n")).drop("_n")
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        placed.withColumn("_before", F.sum("n").over(inside) - F.col("n"))
        .join(firsts, [shard, "_bucket"])
        .withColumn("_start", F.col("_first") + F.col("_before"))
        .drop("_bucket", "_before", "_first")
    )
    numbered = scratch.write(numbered, "numbered")
    each = lambda df: df.withColumn("slot", F.explode(F.sequence("_start", F.col("_start") + F.col("n") - 1))).drop("_start", "n")
    # Many rows alike: in stretches, which are dealt out before they become rows again.
    many = numbered.where(F.col("n") > BUCKET_ROWS)
    stretches = many.withColumn("_from", F.explode(F.sequence("_start", F.col("_start") + F.col("n") - 1, F.lit(BUCKET_ROWS).cast("long"))))
    left = F.least(F.col("_start") + F.col("n") - F.col("_from"), F.lit(BUCKET_ROWS).cast("long"))
    stretches = stretches.withColumn("n", left).withColumn("_start", F.col("_from")).drop("_from").repartition("_start")
    return each(numbered.where(F.col("n") <= BUCKET_ROWS)).unionByName(each(stretches))


def shard_documents(docs: DataFrame, shards: int = DEFAULT_SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: its shard of `shards`, slot in it, and shard once one more exists.

    Returns doc_id, size (UTF-8 bytes + 8), text_crc32, shard, slot, grown_shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ["doc_id", "text_crc32", "size"]
    alike = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    scratch = Scratch(docs.sparkSession, "shards")
    rows = scratch.write(alike.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn(
        "grown_shard", shard_of(F.col("doc_id"), shards + 1)), "rows")
    return number_slots(scratch, rows, "shard", order, shards).select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = DEFAULT_SHARDS, key_col: str = "doc_id") -> None:
    """Write whole rows to `path`/shard=N/; a shard may have several files, none is gathered."""
    docs.withColumn("shard", shard_of(F.col(key_col), shards)).write.partitionBy("shard").parquet(path)
