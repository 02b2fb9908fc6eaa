"""Differences of two tables as multisets: what is there and shouldn't be, and the other way round."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The two sides.
UNEXPECTED, MISSING = "unexpected", "missing"


def multiset_difference(actual: DataFrame, expected: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that the two sides have in different numbers: the columns, ``side``, ``n_rows`` (how many more).

    NULLs are equal to one another, and so are NaNs.  Both sides are counted in one grouping: rows
    collapse by their columns in each task before its one shuffle, so rows that repeat, however often, cost
    one row a task.  Types must agree; columns are matched by name.
    """
    columns = list(columns or expected.columns)
    types = [{f.name: f.dataType for f in df.schema.fields} for df in (actual, expected)]
    for c in columns:
        if c not in types[0] or c not in types[1] or types[0][c] != types[1][c]:
            raise ValueError(f"column {c!r} is not of one type on both sides: {types[0].get(c)} and {types[1].get(c)}")
    signed = [df.select(*[F.col(f"`{c}`") for c in columns], F.lit(sign).cast("long").alias("__n")) for df, sign in ((actual, 1), (expected, -1))]
    more = signed[0].unionByName(signed[1]).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("__n").alias("n_rows")).where("n_rows <> 0")
    return more.select(*[F.col(f"`{c}`") for c in columns], F.when(F.col("n_rows") > 0, UNEXPECTED).otherwise(MISSING).alias("side"),
                       F.abs("n_rows").alias("n_rows"))
