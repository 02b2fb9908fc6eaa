"""Quality ranking: held-out accuracy, the cut, and the defined cases."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from auditlane.llm import quality
from tests.conftest import SF_CHECK
from tests.llm.helpers import frame, rows


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    held = quality.held_out(F.col("doc_id"), 4, 2)
    ranker = quality.learn(docs.where(~held), labels.where(~held))
    scored = quality.score_documents(docs, ranker)
    assert scored.count() == docs.count()
    judged = scored.join(labels, "doc_id").where(held).collect()
    right = sum((r.score >= quality.KEEP_SCORE) == (r.quality == 1) for r in judged)
    assert right / len(judged) > 0.97 and len(judged) > 50


def test_pairs_teach_the_order_and_the_quantile_the_cut():
    draw = np.random.default_rng(3)
    good = np.arange(400) % 4 != 0
    x = draw.normal(size=(400, 5))
    x[:, 2] += 4 * good
    ranker = quality.fit_pairs(x, good, bad_share=0.25, pairs=5_000)
    assert ranker.weights[2] > 3 * np.abs(np.delete(ranker.weights, 2)).max()
    score = ranker.score(x)
    assert abs((score < quality.KEEP_SCORE).mean() - 0.25) < 0.02
    half = quality.fit_pairs(x, good, bad_share=0.25, pairs=5_000, quantile=0.5)
    assert (half.score(x) < quality.KEEP_SCORE).mean() > 0.45
    # Gradient of the penalised logistic loss vanishes at the weights.
    z = quality._standard(x, ranker.center, ranker.scale)
    pairs = np.random.default_rng(quality.SEED)
    d = z[pairs.choice(np.flatnonzero(good), 5_000)] - z[pairs.choice(np.flatnonzero(~good), 5_000)]
    slope = d.T @ (1 / (1 + np.exp(d @ ranker.weights))) / 5_000 - quality.RIDGE * ranker.weights
    assert np.abs(slope).max() < 1e-5


def test_awkward_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (16, 0, 0), (7, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark)
    ranker = quality.learn(docs, labels)
    got = quality.score_documents(docs, ranker).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, *_ in rows())
    assert all(0 <= r.score <= 1 for r in got)
    assert all(len(quality.features(t)) == len(quality.NAMES) and np.isfinite(quality.features(t)).all() for _, t, *_ in rows())
    assert quality.features(None) == quality.features("")


def test_nothing_to_learn_from_and_empty_tables(spark):
    docs, none = frame(spark), spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(docs, quality.learn(docs, none)).collect()} == {0.5}
    one_class = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.learn(docs, one_class).cut is None
    empty = frame(spark, [])
    assert quality.score_documents(empty, quality.learn(empty, one_class)).collect() == []


def test_learning_rows_are_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    a, b = quality.learn(docs, labels, learn_rows=20), quality.learn(docs, labels, learn_rows=20)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_labels_of_held_out_rows_change_nothing(spark, tmp_path, monkeypatch):
    from auditlane.llm import queries

    held = quality.held_out(F.col("doc_id"), 4, 2)
    flip = F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{SF_CHECK}/{name}.parquet")
        (df.withColumn("quality", flip) if name == "labels" else df).write.parquet(str(tmp_path / f"{name}.parquet"))
    scores = [sorted((r.doc_id, r.score) for r in queries.op1_quality(spark, d).collect()) for d in (SF_CHECK, str(tmp_path))]
    assert scores[0] == scores[1]


def test_a_repeated_id_gives_one_row_to_learn_from(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality, "fit_pairs", lambda x, *rest: sizes.append(x.tolist()))
    data = [(k, f"words {k}", "en", "a") for k in range(6)] + [(5, "other text! " * n, "en", "a") for n in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, quality int")
    for parts in (1, 5):
        quality.learn(frame(spark, data).repartition(parts), labels)
    assert len(sizes[0]) == 6 and sizes[0] == sizes[1]


def test_pairwise_fit_against_brute_force():
    """Weights of small data, by many plain gradient steps over the same pairs, one pair after the other."""
    draw = np.random.default_rng(11)
    good = np.arange(30) % 3 != 0
    x = draw.normal(size=(30, 3))
    x[:, 1] += 1.5 * good
    ranker = quality.fit_pairs(x, good, bad_share=1 / 3, pairs=200)
    z = quality._standard(x, x.mean(0), x.std(0))
    pick = np.random.default_rng(quality.SEED)
    pairs = list(zip(pick.choice(np.flatnonzero(good), 200), pick.choice(np.flatnonzero(~good), 200)))
    weights = np.zeros(3)
    for _ in range(3_000):
        slope = -quality.RIDGE * weights
        for winner, loser in pairs:
            d = z[winner] - z[loser]
            slope = slope + d / (1 + np.exp(d @ weights)) / len(pairs)
        weights = weights + 0.5 * slope
    assert np.allclose(weights, ranker.weights, atol=1e-2)
    strength = sorted(z @ ranker.weights)
    assert sum(s < ranker.cut for s in strength) in (8, 9, 10, 11, 12)


def test_every_labelled_row_and_pair_teaches(spark):
    """Weights and cut by brute force over all rows and pairs, wherever the learning starts."""
    draw = np.random.default_rng(5)
    docs, labels = [], []
    for k in range(240):
        good = k % 3 != 0
        words = ["w" * n for n in draw.integers(2, 6 if draw.random() < 0.3 else 8 if good else 5, draw.integers(3, 40))]
        docs.append((k, " ".join(w.upper() if draw.random() < (0.05 if good else 0.1) else w for w in words), "en", "a"))
        labels.append((k, int(good)))
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    some, more = (quality.learn(frame(spark, docs), known, learn_rows=n) for n in (8, 4_000))
    assert np.allclose(some.weights, more.weights, atol=1e-6) and abs(some.cut - more.cut) < 1e-5
    x = quality._matrix([t for _, t, *_ in docs])
    good = np.array([q == 1 for _, q in labels])
    assert np.allclose(some.center, x.mean(0)) and np.allclose(some.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))
    z = quality._standard(x, some.center, some.scale)
    d = (z[good][:, None, :] - z[~good][None, :, :]).reshape(-1, z.shape[1])
    slope = d.T @ (1 / (1 + np.exp(d @ some.weights))) / len(d) - quality.RIDGE * some.weights
    assert np.abs(slope).max() < 1e-5
    ranked = np.sort(z @ some.weights)
    assert abs(some.cut - (ranked[79] + ranked[80]) / 2) < 1e-9


def test_the_cut_is_found_in_narrower_cells(spark, monkeypatch):
    monkeypatch.setattr(quality, "CUT_CELLS", 3)
    width = len(quality.NAMES)
    values = [0.0, 0.1, 0.1, 0.1, 0.2, 5.0, 5.5, 90.0, 1000.0, 1000.0]
    rows = spark.createDataFrame([(k % 2 == 0, [v] + [0.0] * (width - 1)) for k, v in enumerate(values)], "good boolean, x array<double>").repartition(3)
    first = np.eye(width)[0]
    for n in range(1, 10):
        got = quality._cut(rows, quality.Ranker(np.zeros(width), np.ones(width), first, None).strength, {True: 5, False: 5}, 0.5, n / 10)
        ranked = np.clip(values, -6, 6)
        assert got == (ranked[n - 1] + ranked[n]) / 2, n
