"""Post-publish data tests on mart tables: unique, not_null, relationships, accepted_values.

Each test is a violation query; a test passes when it returns nothing.  Counting follows
the usual data-test convention: ``unique`` counts duplicated *values*, ``accepted_values``
counts offending *values*, ``not_null`` and ``relationships`` count offending *rows*.  NULL
child keys are not orphans and NULL is never an unaccepted value.  A value is NULL here as in the
gate: missing, which for floating point includes NaN.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlane.functions.exprs import is_missing


def _missing(df: DataFrame, column: str) -> Column:
    return is_missing(column, df.schema[column].dataType)


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Non-missing values occurring more than once, with their row counts."""
    return (
        df.where(~_missing(df, column))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(_missing(df, column))


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row: a semi join with the orphan keys."""
    orphans = orphan_keys(child, column, parent, parent_column).select(F.col(column).alias("__orphan"))
    return child.join(orphans, F.col(column) == F.col("__orphan"), "left_semi")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent row, with their row counts.

    Child rows are counted by key first (a hot key is one row a task before the shuffle), so whichever
    way Spark joins the distinct keys with the distinct parent keys, no child row is shuffled.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(parent_column).alias("__parent")).distinct()
    return counted.join(keys, F.col(column) == F.col("__parent"), "left_anti")


def _unaccepted(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct non-NULL values outside ``values``, with their row counts."""
    return df.where(_unaccepted(column, values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class DataTest:
    test_id: str
    kind: str  # unique | not_null | relationships | accepted_values
    model: str
    column: str
    parent_model: str | None = None
    parent_column: str | None = None
    values: tuple = ()


def _row(test: DataTest, failures: Column) -> Column:
    n = failures.cast("long")
    return F.struct(
        F.lit(test.test_id).alias("test_id"), F.lit(test.kind).alias("kind"), F.lit(test.model).alias("model"),
        F.lit(test.column).alias("column"), n.alias("failures"), (n == 0).alias("passed"))


def _row_tests(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """Tests that look at rows one by one: one aggregate over one scan, whatever their number."""
    counts = []
    for k, t in enumerate(tests):
        if t.kind == "not_null":
            counts.append(F.count_if(_missing(df, t.column)).alias(f"n{k}"))
        elif t.kind == "accepted_values":
            counts.append(F.count_distinct(F.when(_unaccepted(t.column, t.values), F.col(t.column))).alias(f"n{k}"))
        else:
            raise ValueError(f"unknown data test kind {t.kind!r}")
    return df.agg(*counts).select(F.inline(F.array(*[_row(t, F.col(f"n{k}")) for k, t in enumerate(tests)])))


def run_data_tests(tests: Sequence[DataTest], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per test: test_id, kind, model, column, failures, passed (a single action).

    Per model, one scan serves all row tests; a uniqueness or relationship test takes one of its
    column, whose values are counted before they are shuffled.
    """
    parts = []
    for model in dict.fromkeys(t.model for t in tests):
        own = [t for t in tests if t.model == model]
        rowwise = [t for t in own if t.kind not in ("unique", "relationships")]
        if rowwise:
            parts.append(_row_tests(tables[model], rowwise))
        for t in own:
            if t.kind == "unique":
                found = unique_violations(tables[model], t.column).agg(F.count(F.lit(1)).alias("n"))
            elif t.kind == "relationships":
                orphans = orphan_keys(tables[model], t.column, tables[t.parent_model], t.parent_column)
                found = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
            else:
                continue
            parts.append(found.select(F.inline(F.array(_row(t, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)
