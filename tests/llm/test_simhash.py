"""SimHash: fingerprints, bit-sliced distances, links and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from auditlane.llm import simhash
from auditlane.llm.common import Scratch
from tests.llm.helpers import ascii_lower, frame, rows, words


def brute_print(text, k=4):
    w = [x.encode() for x in words(ascii_lower(text))]
    shingles = [b" ".join(w[a:a + k]) for a in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(prints, ids, radius):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                parent[find(a)] = find(b)
    smallest = {}
    for k, d in enumerate(ids):
        if d is not None:
            smallest[find(k)] = min(d, smallest.get(find(k), d))
    return [smallest.get(find(k)) for k in range(len(prints))]


def near_prints(n, seed):
    draw, out = random.Random(seed), []
    while len(out) < n:
        p = draw.getrandbits(64)
        out.append(p)
        for _ in range(draw.randrange(6)):  # chains of small steps
            for _ in range(draw.randrange(1, 7)):
                p ^= 1 << draw.randrange(64)
            out.append(p)
    return out[:n]


def test_fingerprints():
    texts = [t for _, t, *_ in rows()] + ["a b c", "A B C D", "a b c d e", "é É a", "x" * 10_000]
    assert [simhash.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]
    assert simhash.fingerprint("p q r s t u", 2) == brute_print("p q r s t u", 2)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0


def test_hash_is_the_one_spark_has(spark):
    got = spark.sql("select xxhash64('shared words, Ähnlich') h").first().h
    assert got % 2**64 == xxhash.xxh64_intdigest("shared words, Ähnlich".encode(), 42)


@pytest.mark.parametrize("radius", range(7))
def test_bit_sliced_distances(radius):
    prints = np.array(near_prints(200, radius), dtype=np.uint64)
    a, b = simhash.links_in([prints], [None], radius)
    left, right = prints[:70], prints[60:]
    c, d = simhash.links_in([left, prints[:1]], [right, prints[1:2]], radius)
    for x, y in ((a, b), (c, d)):
        assert all((int(p) ^ int(q)).bit_count() <= radius * 200 for p, q in zip(x, y))
    # The forest connects exactly what the links connect.
    want = brute_components([int(p) for p in prints], list(range(200)), radius)
    label = {int(p): int(p) for p in prints}

    def find(p):
        while label[p] != p:
            p = label[p]
        return p

    for p, q in zip(a, b):
        label[find(int(p))] = find(int(q))
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(find(int(p)), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_blocks_are_abandoned_only_when_every_lane_is_past():
    prints = np.array([0] + [2**64 - 1] * 63, dtype=np.uint64)
    planes = simhash.planes_of(prints.reshape(1, 64))
    rows_, lanes = simhash.compare(np.array([1], dtype=np.uint64), np.array([0]), planes, np.array([2**64 - 1], dtype=np.uint64), 4)
    assert rows_.tolist() == [0] and lanes.tolist() == [0]


@pytest.mark.parametrize("n,radius", [(10, 4), (10**6, 4), (10**10, 4), (500, 2)])
def test_stripes_miss_no_link(n, radius):
    masks, draw = simhash.stripe_masks(n, radius), random.Random(n)
    for _ in range(300):
        flips = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 4, 6])
def test_further_masks_miss_no_link(radius):
    draw = random.Random(radius)
    for mask in draw.sample(simhash.stripe_masks(10**5, radius), 1) + draw.sample(simhash.stripe_masks(10**9, radius), 1):
        masks, free = simhash.further_masks(mask, radius), [b for b in range(64) if not mask >> b & 1]
        assert all(m & mask == mask for m in masks)
        for _ in range(200):
            flips = sum(1 << b for b in draw.sample(free, min(radius, len(free))))
            assert any(not flips & m for m in masks)


def crowd(n, seed):
    """Fingerprints that share 40 bits, some of them near others: one group in many tables."""
    draw = random.Random(seed)
    base = draw.getrandbits(40) << 24
    return [base | (p & 0xFFFFFF) for p in near_prints(n, seed)]


def test_crowded_groups_are_cut_before_they_are_compared(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    signed = sorted({p - 2**64 if p >> 63 else p for p in crowd(600, 3)})
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    blocks = simhash.candidates(Scratch(spark, "test-simhash"), df, 4).selectExpr("size(prints) n", "blocks").collect()
    # Five stripes of which one must agree would give groups of 600; no block holds much more than its share.
    assert max(b.n for b in blocks) <= 2 * 64 and sum(b.n * b.n for b in blocks) < 15 * 600 * 600


@pytest.mark.parametrize("prints", [near_prints(300, 5) + [1 << k for k in range(40)] + [3 << k for k in range(40)], crowd(400, 8)])
def test_links_and_components_match_brute_force(spark, monkeypatch, prints):
    monkeypatch.setattr(simhash, "BLOCK", 16)  # crowded groups, and some of several blocks
    monkeypatch.setattr(simhash, "SPREAD", 2)
    signed = sorted({p - 2**64 if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    scratch = Scratch(spark, "test-simhash")
    got = {r.node: r.root for r in simhash.components(scratch, simhash.links(scratch, df, 4)).collect()}
    want = brute_components([p % 2**64 for p in signed], signed, 4)
    roots = {}
    for p, w in zip(signed, want):
        roots.setdefault(w, set()).add(got.get(p, p))
    assert all(len(r) == 1 for r in roots.values())
    assert len({next(iter(r)) for r in roots.values()}) == len(roots)


def test_awkward_documents(spark):
    got = simhash.near_groups(frame(spark)).collect()
    data = rows()
    prints = [brute_print(t) for _, t, *_ in data]
    want = brute_components(prints, [d for d, *_ in data], 4)
    assert sorted((str(r.doc_id), r.print % 2**64, str(r.component_id)) for r in got) == sorted(
        (str(d), p, str(w)) for (d, *_), p, w in zip(data, prints, want))
    docs = frame(spark)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    components = {}
    for (d, t, *_), p in zip(data, brute_components(prints, list(range(len(data))), 4)):
        components.setdefault(p, []).append(d)
    smallest = [min((d for d in c if d is not None), default=None) for c in components.values()]
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, smallest))


def test_only_null_ids_and_empty_table(spark):
    data = [(None, "p q r s t", "en", "a"), (None, "p q r s t", "en", "a")]
    assert [r.component_id for r in simhash.near_groups(frame(spark, data)).collect()] == [None, None]
    assert simhash.near_groups(frame(spark, [])).collect() == []
    assert simhash.drop_near_copies(frame(spark, [])).collect() == []
