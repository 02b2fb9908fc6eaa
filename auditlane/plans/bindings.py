"""Bind the driver's star-schema test tables to the raw trip and zone shapes.

* ``line_trips``  (dirty): lineitem x orders x customer x supplier.  Keys repeat, because
  (l_orderkey, l_linenumber) is not unique in the test data, and drop-off may precede
  pick-up.
* ``order_trips`` (clean): orders x customer; every rule of the trip suite passes.
* ``nation_zones``: nation x region as the zone dimension.

The raw shapes use the *raw* column names (``pickup_datetime``, ``trip_distance``...), so the
staging contract is exercised exactly as on landed data.  Joins between the large tables
are left to the planner (shuffled, AQE-managed); nothing here is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order status -> payment type code.
STATUS_TO_PAYMENT = (("F", 1), ("O", 2), ("P", 3))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def payment_code(status: str = "o_orderstatus"):
    expr = None
    for code_status, code in STATUS_TO_PAYMENT:
        expr = (F.when(F.col(status) == code_status, F.lit(code)) if expr is None
                else expr.when(F.col(status) == code_status, F.lit(code)))
    return expr.cast("bigint")


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(s, li.l_suppkey == s.s_suppkey)
    )
    price = F.col("l_extendedprice")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        (F.col("l_suppkey") % 2 + 1).alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_linenumber").cast("bigint").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("c_nationkey").cast("bigint").alias("pickup_location_id"),
        F.col("s_nationkey").cast("bigint").alias("dropoff_location_id"),
        price.alias("fare_amount"),
        (price * F.col("l_discount")).alias("tip_amount"),
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"),
        payment_code().alias("payment_type"),
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey")
    return joined.select(
        key.alias("trip_id"),
        (F.col("o_custkey") % 2 + 1).alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.timestamp_add("MINUTE", key % 60 + 1, F.col("o_orderdate")).alias("dropoff_datetime"),
        (key % 4 + 1).alias("passenger_count"),
        (F.col("o_custkey") % 50 + 1).cast("double").alias("trip_distance"),
        F.col("c_nationkey").cast("bigint").alias("pickup_location_id"),
        ((F.col("c_nationkey") + 7) % 25).cast("bigint").alias("dropoff_location_id"),
        F.col("o_totalprice").alias("fare_amount"),
        F.lit(0.0).alias("tip_amount"),
        F.col("o_totalprice").alias("total_amount"),
        payment_code().alias("payment_type"),
    )


def nation_zones(spark: SparkSession, sf_dir: str, drop_region: str | None = None) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    if drop_region is not None:
        r = r.where(F.col("r_name") != drop_region)
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
    )
