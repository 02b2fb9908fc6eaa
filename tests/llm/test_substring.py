"""Substring dedup against every window, in plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from auditlane.llm import substring
from tests.llm.helpers import frame, rows, words


def expected(data, window):
    first = {}
    cut = [(d, words(t)) for d, t, *_ in data]
    for d, w in cut:
        for k in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in cut:
        gone = set()
        for k in range(len(w) - window + 1):
            if d is not None and first[tuple(w[k:k + window])] < d:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def run(spark, data, **options):
    got = substring.remove_repeats(frame(spark, data), **options).collect()
    for r in got:
        assert sum(s.end - s.begin for s in r.removed) == r.n_removed
        assert all(a.end < b.begin for a, b in zip(r.removed, r.removed[1:]))
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


def test_awkward_documents(spark):
    assert run(spark, rows()) == expected(rows(), 50)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_overlaps(spark, seed):
    draw = random.Random(seed)
    passages = [[draw.choice("abcd") + str(draw.randrange(9)) for _ in range(draw.randrange(5, 40))] for _ in range(6)]
    data = []
    for k in range(60):
        w = []
        for _ in range(draw.randrange(0, 7)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            w += p[a:a + draw.randrange(1, 40)] if draw.random() < 0.8 else ["z"] * draw.randrange(1, 30)
        data.append((draw.randrange(50), " ".join(w), "en", "s"))
    assert run(spark, data, window=12, anchor_words=4) == expected(data, 12)


def test_runs_hold_every_window_once():
    roller = substring.Roller()
    w = [str(k * k % 23).encode() for k in range(500)]
    roller.load(w)
    start, length, _, _ = roller.runs(500, 50, 10)
    assert np.concatenate([np.arange(s, s + n) for s, n in zip(start, length)]).tolist() == list(range(451))
    assert length.max() <= 41


def test_intervals_merge():
    assert substring.intervals(np.array([9, 0, 3, 20]), 5) == [(0, 8), (9, 14), (20, 25)]
    assert substring.intervals(np.array([0, 5]), 5) == [(0, 10)]
    assert substring.intervals(np.array([], dtype=int), 5) == []


def test_empty_table(spark):
    assert run(spark, []) == []


def test_segments_change_nothing(spark, monkeypatch):
    draw = random.Random(3)
    passages = [[draw.choice("abcd") + str(draw.randrange(9)) for _ in range(draw.randrange(5, 90))] for _ in range(6)]
    data = [(draw.randrange(50), " ".join(x for _ in range(draw.randrange(0, 9)) for x in draw.choice(passages)[draw.randrange(4):]), "en", "s") for _ in range(60)]
    monkeypatch.setattr(substring, "SEGMENT_BYTES", 100)
    monkeypatch.setattr(substring, "RUNS_AT_ONCE", 2)
    assert run(spark, data, window=12, anchor_words=4) == expected(data, 12)


def test_runs_of_segments_are_those_of_the_whole(monkeypatch):
    text = " ".join(str(k * k % 101) for k in range(5_000))
    whole = [np.concatenate(x) for x in zip(*substring.text_runs(substring.Roller(), text, 50, 10))]
    monkeypatch.setattr(substring, "SEGMENT_BYTES", 700)
    parts = [np.concatenate(x) for x in zip(*substring.text_runs(substring.Roller(), text, 50, 10))]
    assert len(list(substring.text_runs(substring.Roller(), text, 50, 10))) > 10
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_the_identity_of_a_run_comes_from_its_windows():
    roller = substring.Roller()
    found = {}
    for seed in range(4):
        rng = random.Random(seed % 2)
        words_ = [str(rng.randrange(5)).encode() for _ in range(300)]
        roller.load(words_)
        start, length, _, run_ = roller.runs(300, 50, 10)
        for s, n, r in zip(start, length, run_):
            found.setdefault(int(r), set()).add(tuple(tuple(words_[s + t:s + t + 50]) for t in range(n)))
    assert all(len(v) == 1 for v in found.values())


def test_a_very_long_text_takes_little_memory():
    import tracemalloc

    text = " ".join(f"w{k * 7919 % 100_003}" for k in range(4_500_000))  # 29 MB
    roller = substring.Roller()
    tracemalloc.start()
    n = sum(len(x[0]) for x in substring.text_runs(roller, text, 50, 10))
    words_, kept, _ = substring.kept_words(text, [(10, 60), (1_000_000, 2_000_000)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 100_000 and (words_, kept) == (4_500_000, 3_499_950)
    assert peak < 6 * len(text)
