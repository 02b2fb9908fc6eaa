"""Nearest neighbours: recall and exact scores against brute force, and the defined cases."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from auditlane.llm import ann
from tests.conftest import SF_CHECK


def brute(ids, x, asked, k=5):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in np.flatnonzero(asked):
        score = unit @ unit[q]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_against_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    got = ann.nearest(vectors, F.col("vec_id") % 50 == 0).collect()
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    want = brute(ids, x, ids % 50 == 0)
    assert len(got) == 5 * len(want)
    hits = sum(r.vec_id in {v for v, _ in want[r.query_id]} for r in got)
    assert hits / len(got) >= 0.97
    at = {int(i): v for i, v in zip(ids, x)}
    for r in got:
        a, b = at[r.query_id], at[r.vec_id]
        assert math.isclose(r.score, float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), abs_tol=1e-12)
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(mine, mine[1:]))


def none(queries, k=5):
    return np.full((queries, k), -np.inf)


def test_bound_prunes_and_estimates_are_unbiased():
    x = np.random.default_rng(1).normal(size=(3_000, 64))
    x[:2_000:20] = x[5] + 0.1 * np.random.default_rng(2).normal(size=(100, 64))
    turn, x = ann.rotation(64), ann.units(x)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, scalars = ann.encode(x, turn)
    ids = np.arange(3_000)
    q, v, score, measured = ann.search_block(np.array([5]), x[5:6], ids, x, codes, scalars, turn, 5, none(1))
    assert measured < 300 and score.min() > 0.9 and 5 not in v
    estimate, rounding = ann.estimates(x[7:8], codes, scalars, turn)
    error = np.delete(estimate[0] - x @ x[7], 7)
    assert abs(error.mean()) < 0.01
    off = ann.BOUND * np.sqrt(1 - scalars**2) / scalars / np.sqrt(63)
    assert (np.abs(error) < np.delete(off, 7)).mean() > 0.96
    # The counts of shared bits are the product with the rounded query's signs.
    signs = np.where(x @ turn.T > 0, 1.0, -1.0)
    plain = (x[7] @ turn.T) @ signs.T / 8 / scalars
    assert np.abs(estimate[0] - plain).max() <= rounding * 2 and rounding < 0.05


def test_odd_dimensions_and_blocks_in_turn():
    for dim in (1, 7, 65, 130):
        x = ann.units(np.random.default_rng(dim).normal(size=(900, dim)))
        turn, ids, best, found = ann.rotation(dim), np.arange(900), none(3, 4), []
        for lo in range(0, 900, 300):
            own = slice(lo, lo + 300)
            codes, scalars = ann.encode(x[own], turn)
            q, v, score, _ = ann.search_block(np.array([0, 1, 2]), x[:3], ids[own], x[own], codes, scalars, turn, 4, best, bound=4.0)
            found += list(zip(q, v + lo, score))
        for a in range(3):
            mine = sorted((-s, v) for q, v, s in found if q == a)[:4]
            want = sorted((-float(x[a] @ x[j]), j) for j in range(900) if j != a)[:4]
            assert np.allclose([s for s, _ in mine], [s for s, _ in want], atol=1e-9)
            assert np.allclose(best[a], [-s for s, _ in want[::-1]], atol=1e-9)


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 4)
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0, 0.0]), (50, [0.0, 2.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, [1.0, 1.0, 0.0]),
            (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [nan, 0.0, 1.0]), (8, [inf, 0.0, 1.0]), (9, [1.0]),
            (10, []), (None, [1.0, 0.0, 0.0]), (100, None), (150, [0.0, 0.0, 0.0]), (11, [-1.0, 0.0, 0.0]), (12, [1e300, 1e300, 0.0]),
            (13, [1e-300, 0.0, 0.0]), (2, [3.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, b"x", 2.0) for r in data], "vec_id long, embedding array<double>, rank int, ids binary, score double")
    got = ann.nearest(df.repartition(3), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.vec_id, round(r.score, 9)) for r in got if r.query_id == 0] == [(1, 1.0), (2, 1.0), (2, 1.0), (13, 1.0), (3, 0.707106781)]
    assert {r.query_id for r in got} == {0, 50}
    assert 9 not in {r.vec_id for r in got}  # alone of its length
    few = ann.nearest(df.where("vec_id in (0, 1, 11)"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in few] == [(1, 1, 1.0), (2, 11, -1.0)]
    assert ann.nearest(df.where("vec_id = 0"), F.col("vec_id") == 0).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.col("vec_id") % 50 == 0).collect() == []


def test_every_length_is_searched_by_its_own_queries(spark):
    data = [(k, [1.0, float(k)]) for k in range(1, 10)] + [(k, [1.0, 2.0, float(k)]) for k in (50, 100, 150)] + [(200, [1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0, k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(50, 100), (50, 150), (100, 150), (100, 50), (150, 100), (150, 50), (200, 1), (200, 2)]
