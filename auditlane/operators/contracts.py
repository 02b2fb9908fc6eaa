"""Schema contracts: what a table's columns are against what they should be, before any job.

A contract maps column names to types.  Each column of either side gets one status:

* ``same``          the type the contract says;
* ``text``          written as text, to be parsed into the contract's type;
* ``widened``       a wider type of the same kind (int where a byte should be): values may not fit;
* ``narrowed``      a narrower type of the same kind: every value fits;
* ``incompatible``  a type of another kind, which no cast of this package is meant for;
* ``missing``       the table doesn't have it;
* ``extra``         the contract doesn't have it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from auditlane.session import literal_frame

# Kinds of types, each from narrow to wide.
KINDS: tuple[tuple[str, ...], ...] = (
    ("tinyint", "smallint", "int", "bigint", "float", "double"),
    ("date", "timestamp_ntz", "timestamp"),
    ("string",),
    ("boolean",),
)
DIFF_SCHEMA = "position int, column string, status string, expected_type string, actual_type string"
BREAKING = ("missing", "incompatible")


def _kind(name: str) -> str:
    return "double" if name.startswith("decimal") else name  # exact numbers of any size count as the widest


def column_status(expected: str, actual: str) -> str:
    if actual == expected:
        return "same"
    if actual == "string":
        return "text"
    for kind in KINDS:
        if _kind(actual) in kind and _kind(expected) in kind:
            wider = kind.index(_kind(actual)) - kind.index(_kind(expected))
            return "same" if not wider else "widened" if wider > 0 else "narrowed"
    return "incompatible"


def _name(kind: DataType | str) -> str:
    return kind if isinstance(kind, str) else kind.simpleString()


def diff(actual: StructType, contract: Mapping[str, DataType | str]) -> list[tuple]:
    """(position, column, status, expected type, actual type): the contract's columns in its order, then extra ones."""
    types = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = [(c, column_status(_name(t), types[c]) if c in types else "missing", _name(t), types.get(c)) for c, t in contract.items()]
    rows += [(c, "extra", None, t) for c, t in types.items() if c not in contract]
    return [(k, *r) for k, r in enumerate(rows)]


def schema_diff(df: DataFrame, contract: Mapping[str, DataType | str]) -> DataFrame:
    """``diff`` as rows, with no job over the data."""
    return literal_frame(df.sparkSession, diff(df.schema, contract), DIFF_SCHEMA)


def schema_report(df: DataFrame, contract: Mapping[str, DataType | str]) -> DataFrame:
    """``diff`` with the number of values that each column holds (none: missing), in one aggregate over one scan."""
    rows = diff(df.schema, contract)
    present = set(df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"__n{k}") for k, c, *_ in rows if c in present])
    text = lambda v: F.lit(v).cast("string")
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("position"), text(c).alias("column"), text(status).alias("status"), text(e).alias("expected_type"), text(a).alias("actual_type"),
                 (F.col(f"__n{k}") if c in present else F.lit(None).cast("long")).alias("n_values"))
        for k, c, status, e, a in rows])))
