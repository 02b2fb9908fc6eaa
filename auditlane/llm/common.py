"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlane.session import checkpoint_root

# ASCII white space (a word is a maximal run of anything else), ASCII capitals.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """A folder of this run in the shared checkpoint folder; tables written there cut lineage."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` as Parquet and read it back; later failures resume from these files."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    `lower` is right (and fast) for pure ASCII; other texts take `translate`, which leaves
    letters such as the accented capitals alone.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def with_keys(df: DataFrame, **keys: Column) -> tuple[DataFrame, list[str]]:
    """Add columns that equal rows share, nulls included, under names no table has; and those names.

    Plain columns can be joined and grouped by in one shuffle, where null-safe equality needs two.
    """
    names = []
    for name, key in keys.items():
        df = df.withColumn(f"__{name}", F.coalesce(key.cast("string"), F.lit(""))).withColumn(f"__{name}_null", key.isNull())
        names += [f"__{name}", f"__{name}_null"]
    return df, names
