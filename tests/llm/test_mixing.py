"""Mixing: targets against the iterated rule, the tree's sums, and every copy accounted for."""

from __future__ import annotations

from collections import Counter

from auditlane.llm import mixing
from tests.llm.helpers import frame, rows, words


def expected_targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, target, open_ = share * sum(sizes.values()), {}, list(order)
    while True:
        left = total - sum(target.values())
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        open_ = [s for s in open_ if s not in over]
        if not open_:
            return target


def test_targets_follow_the_iterated_rule(spark):
    for sizes in ({"b": 10, "a": 100, None: 7, "é": 50, "Z": 0}, {"x": 5}, {"x": 0, None: 0}, {f"s{k}": 3**k for k in range(9)}):
        df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_rows long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = expected_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_tree_keeps_quotas_and_evens_shards(spark):
    quotas = {0: 37, 1: 5, 2: 1, 3: 120, 4: 0}
    df = spark.createDataFrame(list(quotas.items()), "sid int, quota long")
    for shards in (1, 2, 5, 8):
        rows_ = mixing.split_quotas(df, shards).collect()
        by_source, by_shard = Counter(), Counter()
        for r in rows_:
            assert r.quota >= 0
            by_source[r.sid] += r.quota
            by_shard[r.shard] += r.quota
        assert {s: by_source[s] for s in quotas} == quotas
        assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == shards
    again = mixing.split_quotas(df, 8)
    assert sorted(again.collect()) == sorted(mixing.split_quotas(df, 8).collect())


def test_draw_has_the_hypergeometric_mean(spark):
    df = spark.createDataFrame([(k, 40) for k in range(30)], "sid int, quota long")
    left = [r.quota for r in mixing.split_quotas(df, 2).collect() if r.shard == 0]
    assert sum(left) == 600 and len(set(left)) > 3
    assert sum((x - 20) ** 2 for x in left) / 30 < 3 * 40 * 0.25  # variance of about 10


def test_takes_near_targets(spark):
    data = [(k, "w " * (1 + (k * 7919) % 97), "en", f"s{k % 3}" if k % 7 else None) for k in range(900)]
    for options in ({}, {"share": 0.4}, {"shards": 3}):
        plan = mixing.mix_plan(frame(spark, data), **options).collect()
        assert len(plan) == len(data)
        target, taken = {}, Counter()
        for r in plan:
            assert r["size"] == len(words(dict((d[0], d[1]) for d in data)[r.doc_id]))
            assert r.taken == r["size"] * len(r.shards) <= 2 * r["size"]
            target[r.source] = r.target
            taken[r.source] += r.taken
        assert all(abs(taken[s] - target[s]) <= 3 for s in target)
    first, second = (sorted((r.doc_id, tuple(r.shards)) for r in mixing.mix_plan(frame(spark, data)).collect()) for _ in range(2))
    assert first == second


def test_awkward_documents(spark):
    docs = frame(spark)
    plan = mixing.mix_plan(docs).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in plan) == sorted((str(d), len(words(t))) for d, t, *_ in rows())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns + ["mix_shard", "mix_order"]
    assert mixed.count() == sum(len(r.shards) for r in plan)
    want = Counter((r.doc_id, r.source) for r in plan for _ in r.shards)
    assert Counter((r.doc_id, r.source) for r in mixed.select("doc_id", "source").collect()) == want


def test_empty_table(spark):
    assert mixing.mix_plan(frame(spark, [])).collect() == []
    assert mixing.mix(frame(spark, [])).collect() == []


def test_a_long_document_leaves_the_rest_to_others(spark):
    # Two blocks; the first id puts the long one into the block that is drawn first, the other into the last.
    for at in (1_000, 1_002):
        data = [(k, "w " * 100, "en", "a") for k in range(600)] + [(at, "w " * 100_000, "en", "a")]
        plan = mixing.mix_plan(frame(spark, data), share=0.5).collect()
        assert sum(r.taken for r in plan) == 60_000 and all(len(r.shards) == (r.doc_id < 600) for r in plan)


def test_no_document_fits_into_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 8)
    for seed in (1, 3):
        sizes = {k: 1 + 3 ** ((k * 7919 + seed) % 9) for k in range(300)}
        data = [(k, "w " * n, "en", "ab"[k % 2]) for k, n in sizes.items()]
        plan = mixing.mix_plan(frame(spark, data), share=0.35 + seed / 10, cap=0.9).collect()
        for source in "ab":
            mine = [r for r in plan if r.source == source]
            left = mine[0].target - sum(r.taken for r in mine)
            assert left >= 0 and all(r["size"] > left for r in mine if not r.shards)


def test_empty_documents_stay_under_the_cap(spark):
    """The source that stops at twice its size has no last pass: its empty documents get two copies as well."""
    data = [(k, "w w w", "en", "a") for k in range(40)] + [(100, "", "en", "a"), (101, None, "en", "a")] + [(k + 200, "w " * 50, "en", "b") for k in range(60)]
    plan = mixing.mix_plan(frame(spark, data)).collect()
    assert {r.target for r in plan if r.source == "a"} == {240.0}
    assert {len(r.shards) for r in plan if r.source == "a"} == {2}
    only_empty = mixing.mix_plan(frame(spark, [(1, "", "en", "a"), (2, None, "en", "a")])).collect()
    assert all(r.shards == [] and r.taken == 0 for r in only_empty)


def test_tree_of_very_many_sources(spark):
    """100,000 sources: no row holds them all, and the sums stay exact."""
    df = spark.range(100_000).selectExpr("cast(id as int) AS sid", "id % 3 AS quota")
    got = mixing.split_quotas(df, 8)
    per_shard = {r["shard"]: r["n"] for r in got.groupBy("shard").sum("quota").withColumnRenamed("sum(quota)", "n").collect()}
    assert sum(per_shard.values()) == 99_999 and max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 8
    wrong = got.groupBy("sid").sum("quota").withColumnRenamed("sum(quota)", "n").where("n <> sid % 3")
    assert wrong.count() == 0 and got.where("quota < 0").count() == 0


def test_groups_of_sources_draw_as_one(spark, monkeypatch):
    """With groups of 4 the mean and spread of a source's share are those of one draw."""
    monkeypatch.setattr(mixing, "GROUP", 4)
    df = spark.createDataFrame([(k, 40) for k in range(30)], "sid int, quota long")
    left = [r.quota for r in mixing.split_quotas(df, 2).collect() if r.shard == 0]
    assert sum(left) == 600 and len(set(left)) > 3
    assert sum((x - 20) ** 2 for x in left) / 30 < 3 * 40 * 0.25


def test_a_repeated_id_is_dealt_over_blocks(spark, monkeypatch):
    """One id on most rows, with texts of their own: no block grows with it, and the mix is as near its target."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    written, write = {}, mixing.Scratch.write
    monkeypatch.setattr(mixing.Scratch, "write", lambda self, df, name: written.setdefault(name, write(self, df, name)))
    data = [(7, f"w{k} " * (1 + k % 5), "en", "a") for k in range(600)] + [(k, "w w", "en", "a") for k in range(1_000, 1_100)]
    plan = mixing.mix_plan(frame(spark, data), share=0.6).collect()
    assert written["blocks"].count() > 35
    assert len(plan) == 700 and abs(sum(r.taken for r in plan) - plan[0].target) <= 1
