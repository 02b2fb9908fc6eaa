"""CSV sources and sinks for raw trip and zone files (RFC 4180: quotes are doubled, spaces count).

Column names come from each file's own header, so files may have their columns in any order, and a
renamed upstream column lands under its new name (the staging contract catches it).  Files that
differ in the columns they have can't be one table: that is drift, and the error names the file.
Values land as the text they are, empty text included; the staging step types them, so junk fails
there, as a structural failure of the run, and not while landing.

``inferred_types`` looks at all values of all columns in one pass and says what each column is;
``read_typed`` is a scan with those types, for files whose columns aren't known.
"""

from __future__ import annotations

import csv as text_csv
import io
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from auditlane.operators.staging import NULL_TEXTS, SchemaDriftError

# Raw column types of the trip and zone files.
RAW_TRIPS_TYPES: dict[str, str] = {
    "trip_id": "bigint",
    "vendor_id": "bigint",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "pickup_location_id": "bigint",
    "dropoff_location_id": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "payment_type": "bigint",
}
RAW_ZONES_TYPES: dict[str, str] = {"location_id": "bigint", "borough": "string", "zone": "string"}

QUOTING = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# The header of every file is compared with the columns it is read by.
READING = QUOTING | {"inferSchema": "false", "enforceSchema": "false", "mode": "FAILFAST"}
HEADERS_A_JOB = 64


class HeaderDriftError(SchemaDriftError):
    """A file of a table has other columns than the rest; ``file`` names it."""

    def __init__(self, file: str, columns: Sequence[str], header: Sequence[str]):
        missing, extra = [c for c in columns if c not in header], [c for c in header if c not in columns]
        ValueError.__init__(self, f"{file} has other columns than the other files: missing {missing}, extra {extra}")
        self.table, self.file, self.missing, self.extra = file, file, missing, extra


def _as_path(uri: str) -> str:
    """A file as Spark lists it (percent-encoded), as a path that Spark reads: signs of patterns stand for themselves."""
    return re.sub(r"([][{}*?\\])", r"\\\1", unquote(uri))


def headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file (files without a line are left out).

    A file's header is in its first block: of a file of several blocks, lines of the others may come first.
    One task reads a file's blocks in turn and stops at the first line; a job reads those of ``HEADERS_A_JOB`` files.
    """
    files, found = sorted(map(_as_path, spark.read.text(path).inputFiles())), {}
    for k in range(0, len(files), HEADERS_A_JOB):
        lines = [spark.read.text(f).where(F.col("_metadata.file_block_start") == 0).coalesce(1).limit(1).select(F.lit(f).alias("file"), "value")
                 for f in files[k:k + HEADERS_A_JOB]]
        for r in reduce(DataFrame.unionAll, lines).collect():
            found[r["file"]] = tuple(next(text_csv.reader(io.StringIO(r["value"].removeprefix("﻿"))), ()))
    return found


def read_csv(spark: SparkSession, path: str | Sequence[str], expected: Sequence[str] = (), multi_line: bool = False) -> DataFrame:
    """Scan CSV file(s) at ``path``: every value as text, none of them NULL, columns by each file's own header.

    Files alike in their header are one scan.  Columns come as ``expected`` says if a file has just these,
    else as in the first file; a file with other ones raises ``HeaderDriftError``, before any data is
    read.  ``multi_line`` allows line breaks in quoted values, at the price of files that aren't split.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers(spark, path).items():
        by_header.setdefault(header, []).append(file)
    columns = next((h for h in by_header if set(h) == set(expected)), next(iter(by_header), tuple(expected)))
    if len(set(columns)) < len(columns):
        raise SchemaDriftError("csv", [f"one of each name in {by_header[columns][0]}"], list(columns))
    for header, files in by_header.items():
        if sorted(header) != sorted(columns):
            raise HeaderDriftError(files[0], columns, header)
    ordered = [c for c in expected if c in columns] if set(expected) == set(columns) else list(columns)
    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c)
    parts = [spark.read.options(**READING).option("multiLine", str(multi_line).lower())
             .schema(StructType([StructField(c, StringType()) for c in header])).csv(files).select(*map(text, ordered))
             for header, files in by_header.items()]
    if not parts:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ordered])
    return reduce(DataFrame.unionByName, parts)


def read_trips_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, path, tuple(RAW_TRIPS_TYPES))


def read_zones_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, path, tuple(RAW_ZONES_TYPES))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as headed CSV (one file per partition); timestamps keep microseconds, texts their spaces."""
    df.write.mode(mode).options(**QUOTING).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


# -- columns that aren't known ----------------------------------------------------------

# How values of a type are written; a value counts for a type if it looks like this and can be cast.
LONG_TEXT = r"^[+-]?[0-9]{1,18}$"
DOUBLE_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"
#: From narrow to wide; a column is of the first type that all its values have, else text.
LATTICE = (("bigint", LONG_TEXT), ("double", DOUBLE_TEXT), ("timestamp_ntz", TIMESTAMP_TEXT))


def _is(value: Column, kind: str, pattern: str) -> Column:
    return F.coalesce(value.rlike(pattern), F.lit(False)) & value.try_cast(kind).isNotNull()


def inferred_types(text: DataFrame) -> DataFrame:
    """One row a column of a frame of texts: position, column, n_values, n_null_texts, n_long, n_double, n_timestamp, type.

    One aggregate over one scan: a task keeps five counts a column.  Null texts count for no type.
    """
    names = ("n_long", "n_double", "n_timestamp")
    counts, rows = [], []
    for k, c in enumerate(text.columns):
        value = F.col(f"`{c}`")
        absent = value.isNull() | value.isin(*NULL_TEXTS)
        counts += [F.count_if(~absent).alias(f"v{k}"), F.count_if(absent).alias(f"a{k}")]
        counts += [F.count_if(~absent & _is(value, kind, pattern)).alias(f"{n}{k}") for n, (kind, pattern) in zip(names, LATTICE)]
        kind = F.when(F.col(f"v{k}") == 0, "string")
        for n, (name, _) in zip(names, LATTICE):
            kind = kind.when(F.col(f"{n}{k}") == F.col(f"v{k}"), name)
        rows.append(F.struct(F.lit(k).alias("position"), F.lit(c).alias("column"), F.col(f"v{k}").alias("n_values"), F.col(f"a{k}").alias("n_null_texts"),
                             *[F.col(f"{n}{k}").alias(n) for n in names], kind.otherwise("string").alias("type")))
    return text.agg(*counts).select(F.inline(F.array(*rows)))


def with_types(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """Texts cast to the types given, null texts to NULL; columns of type string stay as they are."""

    def cast(c: str) -> Column:
        value = F.col(f"`{c}`")
        if types[c] == "string":
            return value.alias(c)
        return F.when(~value.isin(*NULL_TEXTS), value).cast(types[c]).alias(c)

    return text.select(*map(cast, text.columns))


def read_typed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A drift-tolerant scan: all columns that the files have, with the types that all their values have."""
    text = read_csv(spark, path)
    return with_types(text, {r["column"]: r["type"] for r in inferred_types(text).collect()})
