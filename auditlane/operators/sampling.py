"""Exact-size, seeded, deterministic row selection without a global sort.

The input is a landed (written) Parquet frame.  Rows are ranked by the md5 of their key and the
seed; rows of one key by a hash of all their typed columns, then by a hash of the file and position
they are stored at.  No two rows share a rank, and rows that are alike in every column differ only in the
last part, where the choice between them doesn't matter.  Selecting the ``n`` rows with the
smallest rank is a pure predicate once the cut is known, and the cut is found
by narrowing prefixes:

1. histogram the first ``fanout`` hex digits (at most 16**fanout small rows reach the
   driver; map-side partial counts keep the shuffle tiny);
2. walk the cumulative counts to the bucket that crosses ``n`` and descend into it;
3. once the crossing bucket holds at most ``final_rows`` rows, take its ranks in order (a
   bounded top-k) and read off the cut.

All of this looks at the key alone, so its scans read the key column and nothing else.  md5 spreads keys
evenly: each level divides the rows by 16**fanout, and 10**12 rows need two levels at the
default fan-out.  A hot key -- a third of all rows with one key -- shows in a histogram as a bucket with one text: only
if the cut falls among its rows are they (and their other columns) ranked, by the same steps, at once.

The result is a filter usable in ``where`` or ``when``; it re-evaluates identically after an
executor loss, because stored rows keep their file and position.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlane.session import lake_root

ROW_DIGITS = 16
DEFAULT_FANOUT = 4
DEFAULT_FINAL_ROWS = 65_536


@dataclass(frozen=True)
class Selection:
    predicate: Column
    selected: int
    total: int


def landed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that each row has a fixed place."""
    path = f"{lake_root(df.sparkSession)}/faults/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame) -> Column:
    """16 hex digits of a hash of every typed column, nulls told apart."""
    parts = [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]
    return F.lpad(F.hex(F.xxhash64(*parts)), ROW_DIGITS, "0")


def key_text(key_cols: Sequence[str], seed: int | str) -> Column:
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def rest_text(df: DataFrame) -> Column:
    place = F.md5(F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string")))
    return F.concat(F.lower(row_hash(df)), place)


@dataclass(frozen=True)
class _Cut:
    total: int
    wanted: int
    text: str = ""  # a whole text or a prefix: all rows up to it are selected, but for
    left: int = 0  # this many of those that share the whole text, where there are more of them


def _find_cut(texts: DataFrame, size: int | Callable[[int], int], fanout: int, final_rows: int) -> _Cut:
    """Where the ``size`` smallest texts of a one-column frame ``__h`` end."""
    prefix, need, total, wanted = "", None, 0, 0
    while True:
        level = texts.where(F.col("__h").startswith(prefix)) if prefix else texts
        bucket = F.substring("__h", len(prefix) + 1, fanout).alias("b")
        hist = sorted(level.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.min("__h").alias("low"), F.max("__h").alias("high")).collect())
        if need is None:
            total = sum(r["n"] for r in hist)
            wanted = need = size(total) if callable(size) else min(int(size), total)
            if need <= 0:
                return _Cut(total, 0)
            if need >= total:
                return _Cut(total, total, "g")  # after every hex digit
        for r in hist:
            if r["n"] >= need:
                break
            need -= r["n"]
        if r["n"] == need:
            return _Cut(total, wanted, prefix + r["b"])
        if r["low"] == r["high"]:  # one hot key: no digit of it parts its rows
            return _Cut(total, wanted, r["low"], need)
        prefix += r["b"]
        if r["n"] <= final_rows:
            break
    own = texts.where(F.col("__h").startswith(prefix))
    last = own.orderBy("__h").limit(need).agg(F.max("__h")).first()[0]
    less, same = own.agg(F.count_if(F.col("__h") < last), F.count_if(F.col("__h") == last)).first()
    return _Cut(total, wanted, last, 0 if less + same == need else need - less)


def fraction_of(fraction: float, minimum: int = 0) -> Callable[[int], int]:
    """Selection size ``max(minimum, int(total * fraction))``, never more than ``total``."""

    def size(total: int) -> int:
        return min(max(minimum, int(total * fraction)), total)

    return size


def select_exact(
    stored: DataFrame,
    size: int | Callable[[int], int],
    *,
    key_cols: Sequence[str],
    seed: int | str,
    fanout: int = DEFAULT_FANOUT,
    final_rows: int = DEFAULT_FINAL_ROWS,
) -> Selection:
    """Exactly ``size`` rows (or ``size(total)``) of a landed frame, smallest key hash first."""
    key = key_text(key_cols, seed)
    cut = _find_cut(stored.select(key.alias("__h")), size, fanout, final_rows)
    if not cut.wanted:
        return Selection(F.lit(False), 0, cut.total)
    upto = lambda text, end: F.substring(text, 1, len(end)) <= F.lit(end)
    if not cut.left:
        return Selection(upto(key, cut.text), cut.wanted, cut.total)
    rest = rest_text(stored)
    inner = _find_cut(stored.where(key == F.lit(cut.text)).select(rest.alias("__h")), cut.left, fanout, final_rows)
    return Selection((key < F.lit(cut.text)) | ((key == F.lit(cut.text)) & upto(rest, inner.text)), cut.wanted, cut.total)
