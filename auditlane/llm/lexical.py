"""Ranked lexical search by the Best Position Algorithm over impact lists.

Index.  Documents are dealt into blocks of about `BLOCK_BYTES` of text, by a task as it reads them.  An
impact list holds, for a term and a block, the documents of the block that have the term and how
often; the list without a term holds all documents of the block that have any, and how many terms each
has.  The index doesn't depend on the queries, and is written once.

Search.  A term's weight comes from its lists' lengths over all blocks, so scores are those of the whole
corpus.  Lists of the terms that are asked for meet their items by a plain join on the term, once for each group of
`ITEMS` items, and come together by block and group of items.  There each item's lists are in order of impact, and
are read by the Best Position Algorithm: a step reads the next positions of every list; a document met
for the first time is looked up in all the item's other lists (direct access), which also marks its
positions there as seen.  A list's best position is the end of its stretch of seen positions from the top;
by direct accesses it runs ahead of the last position read, so the threshold (the sum of impacts at the best positions) is
tighter.  The item is done when the threshold is strictly below its k-th score: no unseen document can then
reach or tie it.  The best k of each block are ranked together; Spark cuts them to k an item in each task before that shuffle.

Size.  A block's lists are in one task: some bytes for each of its terms, whatever the corpus.  A longer text than a block
is one by itself.  A hot term has one list a block.  No list of documents comes to the driver.

Defined cases: null and empty texts, and texts without a term, are no documents (they count nowhere, nothing finds them);
items without a term have no result; terms that no document has, or of weight 0, add nothing; rows that repeat a doc_id are documents each,
null ids come last among equal scores; items that are alike in id and text are one, alike in id only are ranked each by itself;
an empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch, ascii_lower

# What a term is, the scale and steepness of scores, and how much of a length counts.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_PART = 1_000, 1_000_000_000, 1_000, 20, 50

TOP = 50
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 8_192
ITEMS = 1_024
STRIDE = 64

LISTS = "block long, term string, n int, slots array<int>, counts array<int>, ids array<long>"

# Bytes that part terms become spaces, capitals small letters; bytes over 127 belong to terms.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 256)
for _from, _to in ((b"0123456789", b"0123456789"), (bytes(range(97, 123)), bytes(range(97, 123))), (bytes(range(65, 91)), bytes(range(97, 123)))):
    _FOLD[list(_from)] = list(_to)


# -- index ------------------------------------------------------------------------------

def count_terms(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Terms, and for each (term, text) that meet, by term and text: place of the term, place of the text, times."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    own = _FOLD[np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]]] if data is not None else np.zeros(0, np.uint8)
    folded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(starts - starts[0]), pa.py_buffer(own))
    parts = pc.split_pattern(folded, " ")
    text = np.repeat(np.arange(len(texts)), np.diff(np.asarray(parts.offsets)))
    coded = parts.flatten().dictionary_encode()
    terms, code = coded.dictionary.to_pylist(), np.asarray(coded.indices)
    if "" in terms:
        kept = code != terms.index("")
        code, text = code[kept], text[kept]
    met, times = np.unique(code.astype(np.int64) * max(1, len(texts)) + text, return_counts=True)
    return terms, met // max(1, len(texts)), met % max(1, len(texts)), times


def _lists(block: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The impact lists of a block, and the one of its documents."""
    terms, term, slot, times = count_terms(texts)
    lengths = np.bincount(slot, times, minlength=len(ids)).astype(np.int32)
    some = np.flatnonzero(lengths)
    first = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.concatenate([first, [len(term)]]).astype(np.int32)
    cut = np.concatenate([ends, [len(term) + len(some)]]).astype(np.int32)
    nested = lambda own, whole: pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([own, whole]), pa.int32()))
    names = [terms[k] for k in term[first]] + [None]
    of_ids = pa.ListArray.from_arrays(pa.array([0] * len(names) + [len(some)], pa.int32()), ids.cast(pa.int64()).take(pa.array(some)))
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(names), pa.int64()), pa.array(names, pa.string()), pa.array(np.diff(cut), pa.int32()),
         nested(slot, some), nested(times, lengths[some]), of_ids],
        ["block", "term", "n", "slots", "counts", "ids"])


def build_index(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Impact lists of all documents (schema `LISTS`), written; the list without a term is its block's documents."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        waiting, size, rows = [], 0, 0

        def block() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting).combine_chunks().to_batches()
            made = _lists((task.partitionId() << 32) + number, table[0].column(0), table[0].column(1)) if table else None
            if made is not None and made.num_rows > 1:  # else no document of it has a term
                yield made

        for part in parts:
            sizes = np.asarray(pc.fill_null(pc.binary_length(part.column(1)), 0))
            ends, lo = np.cumsum(sizes), 0
            while lo < len(sizes):
                before = ends[lo - 1] if lo else 0
                hi = int(np.searchsorted(ends, before + block_bytes - size, "right"))
                hi = min(max(hi, lo if waiting else lo + 1), lo + block_rows - rows, len(sizes))
                if hi > lo:
                    waiting.append(part.slice(lo, hi - lo))
                    size, rows = size + int(ends[hi - 1] - before), rows + hi - lo
                lo = hi
                if lo < len(sizes):
                    yield from block()
                    waiting, size, rows, number = [], 0, 0, number + 1
        if waiting:
            yield from block()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return scratch.write(texts.mapInArrow(batches, LISTS), "index")


# -- search -----------------------------------------------------------------------------

class ImpactList:
    """Documents of a term in order of impact, and their positions by document."""

    def __init__(self, slots: np.ndarray, impacts: np.ndarray):
        order = np.argsort(-impacts, kind="stable")
        self.slots, self.impacts = slots[order], impacts[order]
        self.known, self.by_slot = slots, impacts  # ascending by document
        self.position = np.empty(len(slots), dtype=np.int64)
        self.position[order] = np.arange(len(slots))

    def look(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `slots` are in the list, and their places in `known`."""
        place = np.searchsorted(self.known, slots)
        place[place == len(self.known)] = 0
        return self.known[place] == slots, place


def best_positions(lists: list[ImpactList], k: int, tie: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, int]:
    """The k documents of greatest sums (ties by `tie`), their sums, and how many documents were looked at."""
    seen = [np.zeros(len(x.slots) + 1, dtype=bool) for x in lists]
    best = [0] * len(lists)  # positions from the top that are all seen
    met, found, sums, at = np.zeros(len(tie), dtype=bool), [], [], 0
    while True:
        fresh = np.unique(np.concatenate([x.slots[at:at + stride] for x in lists]))
        fresh = fresh[~met[fresh]]
        if len(fresh):
            met[fresh] = True
            total = np.zeros(len(fresh), dtype=np.int64)
            for x, marks in zip(lists, seen):
                here, place = x.look(fresh)
                total[here] += x.by_slot[place[here]]
                marks[x.position[place[here]]] = True
            found.append(fresh)
            sums.append(total)
        at += stride
        threshold, left = 0, False
        for j, (x, marks) in enumerate(zip(lists, seen)):
            best[j] += int(np.argmin(marks[best[j]:]))
            if best[j] < len(x.slots):
                left = True
                threshold += int(x.impacts[best[j] - 1])  # every list has been read once, so its top is seen
        scores = np.concatenate(sums)
        if not left or (len(scores) >= k and threshold < np.partition(scores, len(scores) - k)[len(scores) - k]):
            break
        stride = min(2 * stride, 4_096)
    slots = np.concatenate(found)
    order = np.lexsort((tie[slots], -scores))[:k]
    return slots[order], scores[order], len(slots)


FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def search_block(group: pa.Table, n_docs: int, n_terms: int, k: int) -> pa.Table:
    """Best k documents of a block for each item that asks it; rows: term, weight, items, slots, counts, ids."""
    group = group.combine_chunks()

    def nested(name: str, rows: np.ndarray) -> list[np.ndarray]:
        column = group.column(name).chunk(0)
        ends, values = np.asarray(column.offsets), column.values
        return [np.asarray(values.slice(ends[r], ends[r + 1] - ends[r]), dtype=np.int64) for r in rows]

    whole = np.asarray(group.column("term").is_null())
    (own,), lists = np.flatnonzero(whole), np.flatnonzero(~whole)
    (slots,), (lengths,) = nested("slots", [own]), nested("counts", [own])
    ids = group.column("ids").chunk(0)[int(own)].values
    size, name = np.zeros(int(slots[-1]) + 1, dtype=np.int64), np.zeros(int(slots[-1]) + 1, dtype=np.int64)
    size[slots] = 100 - LENGTH_PART + (LENGTH_PART * lengths * n_docs) // n_terms
    unnamed = np.zeros(len(size), dtype=bool)
    name[slots], unnamed[slots] = np.asarray(pc.fill_null(ids, 0)), np.asarray(ids.is_null())
    tie = np.empty(len(size), dtype=np.int64)
    tie[np.lexsort((name, unnamed))] = np.arange(len(size))

    asked: dict[int, list[ImpactList]] = {}
    weights = np.asarray(group.column("weight"))[lists]
    for items, weight, known, tf in zip(nested("items", lists), weights, nested("slots", lists), nested("counts", lists)):
        if weight > 0:
            x = ImpactList(known, int(weight) * ((IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * size[known])))
            for item in items:
                asked.setdefault(int(item), []).append(x)
    out = [(np.zeros(0, np.int64),) * 3]
    for item, own_lists in sorted(asked.items()):
        best, scores, _ = best_positions(own_lists, k, tie)
        best, scores = best[scores > 0], scores[scores > 0]
        out.append((np.full(len(best), item), best, scores))
    item, best, score = (np.concatenate(c) for c in zip(*out))
    return pa.table([pa.array(item), pa.array(name[best], mask=unnamed[best]), pa.array(score)], schema=FOUND)


def search(index: DataFrame, items: DataFrame, scratch: Scratch, k: int = TOP, items_a_group: int = ITEMS,
           id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each item's k best documents: item_id, rank, doc_id, score."""
    # Items, numbered; their terms, each with the items of a group that ask for it.
    named = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    terms = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))
    numbered = scratch.write(named.select("item_id", F.monotonically_increasing_id().alias("item"), terms.alias("terms")).where(F.size("terms") > 0), "items")
    groups = max(1, -(-numbered.count() // items_a_group))
    asks = numbered.select(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group"), "item", F.explode("terms").alias("term"))
    wanted = scratch.write(asks.groupBy("term", "group").agg(F.collect_list("item").alias("items")), "wanted")

    lists, documents = index.where("term is not null"), index.where("term is null")
    totals = documents.agg(F.sum(F.col("n").cast("long")), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 1
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.sum(F.col("n").cast("long")) + 1).cast("double")
    weights = lists.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(
        F.floor(WEIGHT_SCALE * F.log(ratio)).cast("long").alias("weight"))
    # Written, so that its size is known when the join with the lists is planned.
    weighed = scratch.write(wanted.join(weights, "term"), "weighed")

    columns = ("block", "group", "term", "weight", "items", "slots", "counts", "ids")
    met = lists.join(weighed, "term").select(*columns)
    each = documents.withColumns({"group": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))), "weight": F.lit(0).cast("long"),
                                  "items": F.array().cast("array<long>")}).select(*columns)
    found = met.unionByName(each).groupBy("block", "group").applyInArrow(
        lambda group: search_block(group, n_docs, n_terms, k), "item long, doc_id long, score long")
    ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
