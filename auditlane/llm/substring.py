"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

A window is `window` consecutive words of one document.  A window whose words also start in a
document with a smaller doc_id is removed there; covered words merge into maximal intervals.

Every window of every text is hashed (rolling polynomials from prefix sums, modulo 2^64, over
hashes of the words) and counted in Spark, but windows travel in runs.  The anchor of a window is the
smallest of the hashes of its sequences of `ANCHOR_WORDS` words; consecutive windows with one
anchor make a run of at most 41 windows, about 21 on average, and a row, whose identity is made from the hashes of
its windows, in order.  Equal windows have equal anchors, so:

1. Runs are grouped by anchor.  An anchor in one document only has no window in another, and is
   done with.  That leaves runs in or near repeated passages.
2. Where all runs of a shared anchor are equal (the inside of a passage), the run is removed as
   a whole from all documents but the smallest.
3. Where they differ (where passages begin and end), the hashes of each distinct run's windows
   are taken from its smallest document and counted one by one.

Texts are read in segments of about `SEGMENT_BYTES`, and a run that a segment cuts begins the next one, so a very long
text costs its task a few times `SEGMENT_BYTES` beside itself.

Runs and windows are compared by anchor and hash, 128 bits together.  Texts are shuffled once; only those
with a shared anchor are written for the second look.  A passage that a third of all documents
share is combined before the shuffle in 1, and its join is one that adaptive execution splits.

Defined cases: null text: no words; fewer words than a window: nothing removed; repeats within
one document stay; very long texts go segment by segment; a null doc_id is neither smaller nor larger than others, so nothing is removed from it or
for it; rows that repeat a doc_id are documents each, and none is smaller; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

WINDOW = 50
ANCHOR_WORDS = 10
BATCH = 512
BASE = 0x9E3779B97F4A7C15 | 1
SPAN = 64  # a run's start and length share a long
SEGMENT_BYTES = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"
RUNS_AT_ONCE = 4_096


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some `SEGMENT_BYTES` of it at a time."""
    data = (text or "").encode("utf-8", "replace")
    at = 0
    while at < len(data):
        end = min(at + SEGMENT_BYTES, len(data))
        while end < len(data) and data[end] not in SPACES:  # no word is cut
            end += 1
        words = data[at:end].split()
        at = end
        if words:
            yield words


def segments(text: str | None, overlap: int) -> Iterator[tuple[int, list[bytes], bool]]:
    """(place of the first word, words, whether they are the last); a segment repeats the `overlap` words before it."""
    first, words = 0, []
    for block in word_blocks(text):
        if len(words) > overlap:
            yield first, words, False
            first, words = first + len(words) - overlap, words[len(words) - overlap:]
        words = words + block
    yield first, words, True


def _stir(x: np.ndarray) -> np.ndarray:
    """A bijection that makes all bits of a polynomial hash depend on each other."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Roller:
    """Hashes of word sequences of one text after another; the powers of the base are kept."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def load(self, words: list[bytes]) -> None:
        n = len(words)
        if len(self.up) <= n:
            size = max(1024, 2 * n)
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, dtype=np.uint64), np.full(size, b, dtype=np.uint64)]))
                for b in (np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))))
        of = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=n)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(of * self.up[:n], dtype=np.uint64)])

    def hashes(self, starts: np.ndarray, lengths) -> np.ndarray:
        """Hash of `lengths` words from each start (the same for equal sequences anywhere)."""
        return _stir((self.sums[starts + lengths] - self.sums[starts]) * self.down[starts])

    def runs(self, n: int, window: int, anchor_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, anchor, identity) of the runs of windows with one anchor."""
        anchors = self.hashes(np.arange(n - anchor_words + 1), anchor_words)
        view = np.lib.stride_tricks.sliding_window_view(anchors, window - anchor_words + 1)
        # Blockwise: a view's minimum is taken from a copy of it.
        place = np.concatenate([lo + np.arange(len(part)) + part.argmin(1)
                                for lo in range(0, len(view), 16_384) for part in (view[lo:lo + 16_384],)])
        start = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        length = np.diff(np.append(start, len(view)))
        every = self.hashes(np.arange(len(view)), window)
        turn = (np.arange(len(view)) - np.repeat(start, length)).astype(np.uint64)
        whole = np.add.reduceat(_stir(every + turn * np.uint64(BASE)), start) + length.astype(np.uint64)
        return start, length, anchors[place[start]], whole


def text_runs(roller: Roller, text: str | None, window: int, anchor_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, length, anchor, identity) of a text's runs, segment by segment."""
    first, carried = 0, []
    blocks = word_blocks(text)
    block = next(blocks, None)
    while block is not None:
        words, block = carried + block, next(blocks, None)
        carried = words
        if len(words) < window:
            continue
        roller.load(words)
        start, length, anchor, run = roller.runs(len(words), window, anchor_words)
        if block is not None:  # the last run may go on
            last = int(start[-1])
            start, length, anchor, run = (x[:-1] for x in (start, length, anchor, run))
            carried = words[last:]
        yield start + first, length, anchor, run
        first += len(words) - len(carried)


def _runs(docs: DataFrame, window: int, anchor_words: int) -> DataFrame:
    """id, text_key, span, anchor, run: one row for each run of windows."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for part in parts:
            for first in range(0, part.num_rows, BATCH):
                some = part.slice(first, BATCH)
                rows = []
                for doc_id, key, text in zip(*(c.to_pylist() for c in some.columns)):
                    for start, length, anchor, run in text_runs(roller, text, window, anchor_words):
                        rows.append((np.full(len(start), doc_id), np.full(len(start), key), start * SPAN + length,
                                     np.ascontiguousarray(anchor).view(np.int64), np.ascontiguousarray(run).view(np.int64)))
                if rows:
                    yield pa.RecordBatch.from_pydict({
                        name: pa.array(np.concatenate(column).astype(np.int64))
                        for name, column in zip(("id", "text_key", "span", "anchor", "run"), zip(*rows))})

    return docs.where("id is not null").select("id", "text_key", "text").mapInArrow(
        batches, "id long, text_key long, span long, anchor long, run long")


def kept_words(text: str | None, gone: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Words of a text, how many of them lie outside the intervals `gone` (in order), and the SHA-256 of those, joined by a space."""
    digest, n, kept, k = hashlib.sha256(), 0, 0, 0
    for words in word_blocks(text):
        left, at = [], 0
        while k < len(gone) and gone[k][0] < n + len(words):
            left += words[at:max(at, gone[k][0] - n)]
            at = min(gone[k][1] - n, len(words))
            if gone[k][1] > n + len(words):
                break
            k += 1
        left += words[at:]
        if left:
            digest.update((b" " if kept else b"") + b" ".join(left))
        n, kept = n + len(words), kept + len(left)
    return n, kept, digest.hexdigest()


def _hashes_of(roller: Roller, text: str, start: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the windows of runs, run by run: of each, the segment that holds it whole is looked at."""
    turn = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    at, out = np.repeat(start, length) + turn, np.zeros(length.sum(), dtype=np.uint64)
    done = np.zeros(len(at), dtype=bool)
    for first, words, _ in segments(text, window - 1):
        own = ~done & (at >= first) & (at + window <= first + len(words))
        if own.any():
            roller.load(words)
            out[own] = roller.hashes(at[own] - first, window)
            done |= own
    return out


def _first_look(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """Documents without a shared anchor: their result.  The others: text, and the hashes of the windows asked for."""
    joined = docs.join(asked, ["id", "text_key"], "left").select("id", "text_key", "text", "spans", "anchors", "runs")
    fields = "id long, text_key long, text string, n_words long, sha string, anchors array<long>, runs array<long>, turns array<long>, hashes array<long>"

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for part in parts:
            for first in range(0, part.num_rows, BATCH):
                out = []
                for doc_id, key, text, spans, anchors, runs in zip(*(c.to_pylist() for c in part.slice(first, BATCH).columns)):
                    if spans is None:
                        n, _, sha = kept_words(text, [])
                        out.append((doc_id, key, None, n, sha, None, None, None, None))
                        continue
                    hashed = [[], [], [], []]
                    if spans:
                        spans = np.array(spans, dtype=np.int64)
                        start, length = spans // SPAN, spans % SPAN
                        turn = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                        hashes = _hashes_of(roller, text, start, length, window).view(np.int64)
                        hashed = [np.repeat(np.array(anchors, dtype=np.int64), length), np.repeat(np.array(runs, dtype=np.int64), length), turn, hashes]
                    out.append((doc_id, key, text, None, None, *hashed))
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()] + [pa.list_(pa.int64())] * 4
                names = [f.split()[0] for f in fields.split(", ")]
                yield pa.RecordBatch.from_pydict({n: pa.array(c, type=t) for n, t, c in zip(names, types, zip(*out))})

    return joined.mapInArrow(batches, fields)


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal [from, to) intervals covered by the windows at the starts."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + window).tolist()))


def marked_intervals(starts: list[int], masks: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal intervals covered by the windows `start + t` for each bit t of a run's mask; some runs at a time."""
    order = np.argsort(np.array(starts, dtype=np.int64), kind="stable")
    starts, masks = np.array(starts, dtype=np.int64)[order], np.array(masks, dtype=np.int64)[order]
    out: list[tuple[int, int]] = []
    for lo in range(0, len(starts), RUNS_AT_ONCE):
        own, mask = starts[lo:lo + RUNS_AT_ONCE], masks[lo:lo + RUNS_AT_ONCE]
        at = np.concatenate([own[(mask >> t) & 1 == 1] + t for t in range(SPAN)])
        for a, b in intervals(at, window):
            while out and a <= out[-1][1]:
                last = out.pop()
                a, b = min(a, last[0]), max(b, last[1])
            out.append((a, b))
    return out


def _second_look(texts: DataFrame, window: int) -> DataFrame:
    """id, n_words, n_removed, kept_sha256, removed: texts with (starts, masks) of their removed windows."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for doc_id, text, starts, masks in zip(*(c.to_pylist() for c in part.columns)):
                gone = marked_intervals(starts or [], masks or [], window)
                n, kept, sha = kept_words(text, gone)
                out.append((doc_id, n, n - kept, sha, [{"begin": a, "end": b} for a, b in gone]))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
            if out:
                yield pa.RecordBatch.from_pydict({n: pa.array(c, type=t) for n, t, c in zip(_RESULT, types, zip(*out))})

    return texts.mapInArrow(batches, "id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<begin:long,end:long>>")


_RESULT = ("id", "n_words", "n_removed", "kept_sha256", "removed")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, removed (intervals of word places)."""
    if not 0 < anchor_words <= window or window - anchor_words + 1 >= SPAN:
        raise ValueError("the window may hold at most 62 words more than the anchor")
    scratch = Scratch(docs.sparkSession, "substring")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    runs = scratch.write(_runs(rows, window, anchor_words), "runs")

    anchors = scratch.write(
        runs.groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min("run").alias("_a"), F.max("run").alias("_b"))
        .where(F.col("first") < F.col("last")).select("anchor", "first", (F.col("_a") != F.col("_b")).alias("mixed")), "anchors")
    shared = scratch.write(runs.join(anchors, "anchor"), "shared")

    # Distinct runs of mixed anchors, each with its smallest document as the place to look at.
    mixed = shared.where("mixed")
    place = F.struct("id", "text_key", "span")
    distinct = scratch.write(mixed.groupBy("anchor", "run").agg(F.min(place).alias("at")), "distinct")
    asked = distinct.select(F.col("at.id").alias("id"), F.col("at.text_key").alias("text_key"), F.col("at.span").alias("span"), "anchor", "run")
    plain = shared.where("not mixed").select("id", "text_key").distinct().select(
        "id", "text_key", *[F.lit(None).cast("long").alias(c) for c in ("span", "anchor", "run")])
    others = mixed.select("id", "text_key").distinct().select(
        "id", "text_key", *[F.lit(None).cast("long").alias(c) for c in ("span", "anchor", "run")])
    asked = asked.unionByName(plain).unionByName(others).groupBy("id", "text_key").agg(
        F.collect_list(F.when(F.col("span").isNotNull(), F.struct("span", "anchor", "run"))).alias("_all"))
    asked = asked.select("id", "text_key", *[F.col("_all")[c].alias(f"{c}s") for c in ("span", "anchor", "run")])
    looked = scratch.write(_first_look(rows, asked, window), "looked")

    # Windows of distinct runs, counted one by one.
    windows = looked.where("hashes is not null").select("id", F.explode(F.arrays_zip("anchors", "runs", "turns", "hashes")).alias("w")).select(
        "id", F.col("w.anchors").alias("anchor"), F.col("w.runs").alias("run"), F.col("w.turns").alias("turn"), F.col("w.hashes").alias("hash"))
    windows = windows.distinct()  # rows that repeat a document report its windows again
    firsts = windows.groupBy("anchor", "hash").agg(F.min("id").alias("first"))
    bit = F.expr("shiftleft(cast(1 as bigint), cast(turn as int))")
    masks = windows.join(firsts, ["anchor", "hash"]).where(F.col("first") < F.col("id")).groupBy("anchor", "run").agg(F.bit_or(bit).alias("mask"))
    masks = scratch.write(distinct.join(masks, ["anchor", "run"], "left").select(
        "anchor", "run", F.col("at.id").alias("_smallest"), F.coalesce("mask", F.lit(0).cast("long")).alias("mask")), "masks")

    every = F.expr(f"shiftleft(cast(1 as bigint), cast(span % {SPAN} as int)) - 1")
    whole = shared.where("not mixed and id > first").select("id", "text_key", "span", every.alias("mask"))
    partly = mixed.join(masks, ["anchor", "run"]).select(
        "id", "text_key", "span", F.when(F.col("id") > F.col("_smallest"), every).otherwise(F.col("mask")).alias("mask"))
    removed = whole.unionByName(partly.where("mask != 0")).groupBy("id", "text_key").agg(
        F.collect_list(F.struct(F.floor(F.col("span") / SPAN).cast("long").alias("start"), "mask")).alias("_all"))
    removed = removed.select("id", "text_key", F.col("_all.start").alias("starts"), F.col("_all.mask").alias("masks"))
    again = looked.where("sha is null").select("id", "text_key", "text").join(removed, ["id", "text_key"], "left")
    second = _second_look(again.select("id", "text", "starts", "masks"), window)
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    first = looked.where("sha is not null").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), none.alias("removed"))
    return first.unionByName(second).withColumnRenamed("id", "doc_id")
