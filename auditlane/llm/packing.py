"""Conflict-constrained best-fit packing of documents into fixed-length sequences.

A document's words are cut into pieces of at most `capacity`; every piece goes into one bin
(a training sequence) with room for it.  A bin carries two bitmaps: the places its sources have
taken (`per_source` places each), and its duplicate clusters.  A piece fits a bin if its source has a
place left there and its cluster isn't there yet, so copies of a text never share a sequence and no
source fills one alone.  `PER_SOURCE` is 4 because one source may hold a third of all pieces, most of them far shorter than a
sequence: with 1 a bin holds no more pieces than there are sources, and most bins of a hot source stay nearly empty.

Best fit.  Pieces come by size, largest first.  Bins are ordered by what they have left; the
successor search starts at the smallest residual that holds the piece and goes on, past bins
that conflict, until it finds the tightest compatible one, or opens a bin.  Bins of one residual
are kept by the bitmap of their full sources, so that a search skips them together.  Pieces
alike in size, cluster and source go through one sweep: a bin that conflicts with the first conflicts with all.

Spark deals the documents by hash into groups of about `GROUP_WORDS` words or `GROUP_ROWS` documents,
whichever is less, and packs each group in one task; a bin never spans groups, which costs at most a few unfilled bins each.  Group size, and so memory and
time of a task, don't grow with the input.  A hot source or cluster is spread over all groups.

Defined cases: null and empty texts have no words and no piece; null sources are one source;
texts longer than the capacity are cut, their whole pieces fill bins alone; rows that repeat are
pieces each and share a cluster; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch, ascii_lower, word_count

CAPACITY = 2_048
PER_SOURCE = 4
GROUP_WORDS = 8_000_000
GROUP_ROWS = 40_000
SEED = 31


class Bins:
    """Open bins ordered by residual, and the tightest compatible one for a piece."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.left, self.clusters, self.counts, self.full = [], [], [], []
        self.residuals: list[int] = []  # of open bins, ascending
        self.open: dict[int, dict[int, list[int]]] = {}  # residual -> bitmap of full sources -> bins, ascending

    def _put(self, b: int) -> None:
        residual = self.left[b]
        if residual:
            shelf = self.open.get(residual)
            if shelf is None:
                shelf = self.open[residual] = {}
                insort(self.residuals, residual)
            insort(shelf.setdefault(self.full[b], []), b)

    def _take(self, b: int) -> None:
        residual = self.left[b]
        shelf = self.open[residual]
        bins = shelf[self.full[b]]
        bins.pop(bisect_left(bins, b))
        if not bins:
            del shelf[self.full[b]]
            if not shelf:
                del self.open[residual]
                self.residuals.pop(bisect_left(self.residuals, residual))

    def successors(self, size: int, source: int, cluster: int) -> Iterator[int]:
        """Compatible bins with room, tightest first, as they stand now."""
        for residual in self.residuals[bisect_left(self.residuals, size):]:
            for full, bins in list(self.open.get(residual, {}).items()):
                if not full >> source & 1:
                    for b in bins[:]:
                        if not self.clusters[b] & cluster:
                            yield b

    def fill(self, b: int | None, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into bin b (None: a new one); its bin and offset."""
        if b is None:
            b = len(self.left)
            self.left.append(self.capacity)
            self.clusters.append(0)
            self.counts.append({})
            self.full.append(0)
        else:
            self._take(b)
        offset = self.capacity - self.left[b]
        self.left[b] -= size
        self.clusters[b] |= cluster
        self.counts[b][source] = self.counts[b].get(source, 0) + 1
        if self.counts[b][source] >= self.per_source:
            self.full[b] |= 1 << source
        self._put(b)
        return b, offset


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece.  Clusters are numbers; one that only a single piece has conflicts with none."""
    seen = defaultdict(int)
    for c in clusters:
        seen[c] += 1
    bit = {c: 1 << k for k, c in enumerate(sorted(c for c, n in seen.items() if n > 1))}
    bins = Bins(capacity, per_source)
    home, offset = [0] * len(sizes), [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], clusters[k], sources[k], k))
    at = 0
    while at < len(order):
        size, source, cluster = sizes[order[at]], sources[order[at]], clusters[order[at]]
        mark = bit.get(cluster, 0)
        # A sweep serves copies alike: whatever conflicts with one of them conflicts with the next.
        sweep = bins.successors(size, source, mark)
        while at < len(order) and (sizes[order[at]], sources[order[at]], clusters[order[at]]) == (size, source, cluster):
            home[order[at]], offset[order[at]] = bins.fill(next(sweep, None), size, source, mark)
            at += 1
            if not mark:
                break
    return home, offset


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_words: int = GROUP_WORDS,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin (a string, unique), bin_offset, source, cluster.

    Without `cluster_col`, texts that are equal but for the case of A-Z are a cluster.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    text = F.coalesce(F.col(text_col), F.lit(""))
    cluster = F.xxhash64(ascii_lower(text)) if cluster_col is None else F.xxhash64(F.col(cluster_col))
    rows = scratch.write(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), word_count(text).alias("words"), F.col(source_col).cast("string").alias("source"),
        cluster.alias("cluster"), F.monotonically_increasing_id().alias("row")), "rows")
    total = rows.agg(F.sum("words").alias("words"), F.count_if(F.col("words") > 0).alias("rows")).first()
    groups = max(1, -(-(total["words"] or 0) // group_words), -(-total["rows"] // GROUP_ROWS))
    pieces = rows.where("words > 0").withColumn("group", F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(groups)).cast("int"))

    def one_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "cluster", "row"], kind="stable")
        cut = -(-rows["words"] // capacity)
        out = rows.loc[rows.index.repeat(cut)].reset_index(drop=True)
        out["piece"] = out.groupby("row").cumcount()
        out["first_word"] = out["piece"] * capacity
        out["n_words"] = (out["words"] - out["first_word"]).clip(upper=capacity)
        codes, _ = pd.factorize(out["source"], use_na_sentinel=False)
        home, offset = best_fit(out["n_words"].tolist(), codes.tolist(), out["cluster"].tolist(), capacity, per_source)
        out["bin"] = [f"{g}-{b}" for g, b in zip(out["group"], home)]
        out["bin_offset"] = offset
        return out[["doc_id", "piece", "first_word", "n_words", "bin", "bin_offset", "source", "cluster"]]

    return pieces.groupBy("group").applyInPandas(
        one_group, "doc_id long, piece int, first_word long, n_words long, bin string, bin_offset long, source string, cluster long")
