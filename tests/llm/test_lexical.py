"""Lexical search against scoring every document of every item."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from auditlane.llm import lexical
from auditlane.llm.common import Scratch
from tests.llm.helpers import ascii_lower, frame, rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, rank int, score double, terms string, block int"


def terms(text):
    return TERM.findall(ascii_lower(text))


def expected(docs, items, k):
    own = [(d, terms(t)) for d, t, *_ in docs]
    own = [(d, t) for d, t in own if t]
    n_docs, n_terms = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for d, t in own:
            m = 100 - 50 + (50 * len(t) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10 ** 9 * t.count(x)) // (1000 * t.count(x) + 20 * m))
                        for x in set(terms(text)) if x in t)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def found(spark, docs, items, k=50, block_bytes=lexical.BLOCK_BYTES, block_rows=lexical.BLOCK_ROWS, group=lexical.ITEMS):
    scratch = Scratch(spark, "lexical")
    asked = spark.createDataFrame([(i, t, 1, 2, 3.0, "x", 4) for i, t in items], ITEMS)
    index = lexical.build_index(frame(spark, docs), scratch, block_bytes, block_rows)
    return [tuple(r) for r in lexical.search(index, asked, scratch, k, group).select("item_id", "rank", "doc_id", "score").collect()]


def some(n, m, seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    text = lambda size: " ".join(rng.choice(vocabulary[:rng.choice([3, 20, 60])]) for _ in range(size))
    docs = [(rng.randint(1, n), text(rng.randint(0, 30)), None, None) for _ in range(n)]
    return docs, [(k % (m - 2), text(rng.randint(1, 12))) for k in range(m)]


@pytest.mark.parametrize("k,block_rows,group", [(50, 10_000, 1_024), (5, 40, 3), (1, 7, 1), (1_000, 100, 4)])
def test_results_are_those_of_scoring_everything(spark, k, block_rows, group):
    docs, items = some(400, 10)
    docs, items = docs + rows(), items + [(77, "The quick DOG! straße word"), (78, None), (79, ""), (80, "--- none-such"), (None, "word w1")]
    got = found(spark, docs, items, k, block_rows=block_rows, group=group)
    assert sorted(got, key=key) == sorted(expected(docs, items, k), key=key)


def test_blocks_by_bytes_and_repeated_items(spark):
    docs, items = some(120, 6, seed=3)
    items = items + items[:2]
    assert sorted(found(spark, docs, items, 9, block_bytes=300), key=key) == sorted(expected(docs, items, 9), key=key)


def test_empty_tables(spark):
    docs, items = some(20, 4)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, "", None, None), (2, None, None, None), (3, "-- !", None, None)], items) == []


def test_best_positions_stops_early_and_strictly():
    rng = np.random.default_rng(5)
    lists = []
    for _ in range(4):
        slots = np.sort(rng.choice(20_000, 15_000, replace=False))
        lists.append(lexical.ImpactList(slots, np.sort(rng.pareto(1.0, 15_000) * 1_000).astype(np.int64)[rng.permutation(15_000)]))
    total = np.zeros(20_000, dtype=np.int64)
    for x in lists:
        total[x.known] += x.by_slot
    tie = rng.permutation(20_000)
    want = np.lexsort((tie, -total))[:10]
    got, scores, looked = lexical.best_positions(lists, 10, tie)
    assert list(got) == list(want) and list(scores) == list(total[want])
    assert looked < 10_000  # far from all
    # Ties at the k-th score are all looked at, so that the tie's order decides.
    flat = [lexical.ImpactList(np.arange(500), np.full(500, 7, dtype=np.int64))]
    got, _, looked = lexical.best_positions(flat, 3, np.arange(500)[::-1].copy())
    assert list(got) == [499, 498, 497] and looked == 500


def test_best_positions_run_ahead_of_the_last_read():
    """Two lists in opposite orders share their tops: direct accesses see positions that weren't read."""
    a = lexical.ImpactList(np.arange(1_000), np.arange(1_000, 0, -1))
    b = lexical.ImpactList(np.arange(1_000), np.concatenate([np.arange(1_900, 1_800, -1), np.arange(900, 0, -1)]))
    _, _, looked = lexical.best_positions([a, b], 5, np.arange(1_000), stride=1)
    assert looked <= 16


def test_terms_of_long_and_odd_texts():
    import pyarrow as pa

    texts = ["Ab aB-ab\x00é1 日本", None, "", "[x]`y`{z}~\x7f", "q " * 500_000]
    names, term, text, times = lexical.count_terms(pa.array(texts))
    got = {(names[a], int(b)): int(c) for a, b, c in zip(term, text, times)}
    want = {}
    for b, t in enumerate(texts):
        for a in terms(t):
            want[a, b] = want.get((a, b), 0) + 1
    assert got == want
