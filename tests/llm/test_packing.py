"""Best-fit packing: every word once, no conflicts, and the tightest compatible bin by brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from auditlane.llm import packing
from tests.llm.helpers import frame, rows, words


def brute(sizes, sources, clusters, capacity, per_source):
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], clusters[k], sources[k], k))
    bins, home = [], {}
    many = Counter(clusters)
    for k in order:
        fits = [(left, b) for b, (left, got, inside) in enumerate(bins)
                if left >= sizes[k] and got[sources[k]] < per_source and not (many[clusters[k]] > 1 and clusters[k] in inside)]
        if fits:
            b = min(left for left, _ in fits)
            home[k] = b  # the residual of the bin taken
            b = min(fits)[1]
        else:
            home[k] = None
            b = len(bins)
            bins.append([capacity, Counter(), set()])
        bins[b][0] -= sizes[k]
        bins[b][1][sources[k]] += 1
        bins[b][2].add(clusters[k])
    return bins, home


@pytest.mark.parametrize("seed,capacity,per_source,n_clusters", [(1, 50, 2, 60), (2, 50, 1, 5), (3, 20, 4, 1), (4, 100, 3, 400)])
def test_tightest_compatible_bin(seed, capacity, per_source, n_clusters):
    draw = random.Random(seed)
    kind = {c: draw.randrange(1, capacity + 1) for c in range(n_clusters)}  # copies are alike in size
    clusters = [draw.randrange(n_clusters) for _ in range(300)]
    sizes, sources = [kind[c] for c in clusters], [draw.choice([0, 0, 0, 1, 2]) for _ in range(300)]
    home, offset = packing.best_fit(sizes, sources, clusters, capacity, per_source)
    inside = defaultdict(list)
    for k, b in enumerate(home):
        inside[b].append(k)
    for members in inside.values():
        assert max(Counter(sources[k] for k in members).values()) <= per_source
        assert len({clusters[k] for k in members}) == len(members)
        spans = sorted((offset[k], offset[k] + sizes[k]) for k in members)
        assert spans[0][0] == 0 and spans[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    want, _ = brute(sizes, sources, clusters, capacity, per_source)
    assert sorted(left for left, *_ in want) == sorted(capacity - sum(sizes[k] for k in m) for m in inside.values())


def test_many_copies_are_swept_once():
    n = 4_000
    home, _ = packing.best_fit([10] * n + [3] * n, [0] * (2 * n), [1] * n + [2] * n, 100, 4)
    assert len(set(home[:n])) == n and len(set(home[n:])) == n and set(home[n:]) == set(home[:n])


def test_awkward_documents(spark):
    for options in ({}, {"capacity": 64, "group_words": 1_000}, {"per_source": 1}):
        got = packing.pack(frame(spark), **options).collect()
        capacity, per_source = options.get("capacity", packing.CAPACITY), options.get("per_source", packing.PER_SOURCE)
        want = Counter()
        for d, t, *_ in rows():
            n = len(words(t))
            want.update((d, a, min(capacity, n - a)) for a in range(0, n, capacity))
        assert Counter((r.doc_id, r.first_word, r.n_words) for r in got) == want
        inside = defaultdict(list)
        for r in got:
            inside[r.bin].append(r)
        for members in inside.values():
            assert sum(r.n_words for r in members) <= capacity
            assert max(Counter(r.source for r in members).values()) <= per_source
            assert len({r.cluster for r in members}) == len(members)


def test_given_clusters_and_empty_table(spark):
    data = [(k, f"w{k} x", "en", f"s{k}") for k in range(6)]
    docs = frame(spark, data).drop("cluster").selectExpr("*", "doc_id % 2 as cluster")
    got = packing.pack(docs, cluster_col="cluster").collect()
    assert len({r.bin for r in got}) == 3
    assert packing.pack(frame(spark, [])).collect() == []
