"""Exact dedup against grouping by the whole text."""

from __future__ import annotations

import hashlib

import pytest

from auditlane.llm import exact
from tests.llm.helpers import ascii_lower, frame, rows


@pytest.mark.parametrize("block_bytes", [3, 64, exact.BLOCK_BYTES])
def test_identities_match_whole_texts(spark, block_bytes):
    data = rows() if block_bytes > 3 else [r for r in rows() if len(r[1] or "") < 2_000]
    got = exact.exact_dedup(frame(spark, data), block_bytes=block_bytes).collect()
    groups = {}
    for doc_id, text, *_ in data:
        groups.setdefault(hashlib.sha256(ascii_lower(text).encode()).hexdigest(), []).append(doc_id)
    assert len(got) == len(data)
    seen = {}
    for r in got:
        group = groups[r.text_sha256]
        seen.setdefault(r.text_sha256, []).append(r)
        assert r.group_size == len(group)
        assert r.keep_id == max((d for d in group if d is not None), default=None)
    for sha, members in seen.items():
        assert sorted(map(str, (m.doc_id for m in members))) == sorted(map(str, groups[sha]))
        stays = [m for m in members if m.kept]
        assert len(stays) == 1 and stays[0].doc_id == stays[0].keep_id


def test_pairs_with_a_missing_part_are_not_named(spark):
    # Equal but for one block in the middle: the other blocks are all repeated.
    base = "".join(f"{k:08d}" for k in range(11))
    data = [(k, base[:24] + f"{k:08d}"[::-1] + base[32:], "en", "s") for k in range(5)] + [(9, base, "en", "s"), (10, base, "en", "s")]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_dedup(frame(spark, data), block_bytes=8).collect()}
    assert got == {k: (k, 1) for k in range(5)} | {9: (10, 2), 10: (10, 2)}


def _names(spark, data, partitions):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    docs = session.createDataFrame([(d, t) for d, t, *_ in data], "doc_id long, text string").repartition(partitions)
    return sorted((r.text_sha256, r.level, r.name["hash"], r.name["place"]) for r in exact.identities(docs, block_bytes=64).collect())


def test_every_text_has_an_identity_that_partitions_do_not_change(spark):
    data = rows()
    few, many = _names(spark, data, 2), _names(spark, data, 9)
    assert few == many and len(few) == len(data)
    assert len({n[1:] for n in few}) == len({n[0] for n in few}) == len({ascii_lower(t) for _, t, *_ in data})


def test_blocks_whose_hashes_collide_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact, "_hash", lambda *parts: exact.F.pmod(exact.F.xxhash64(*parts), exact.F.lit(2)))
    data = [r for r in rows() if len(r[1] or "") < 2_000]
    got = exact.exact_dedup(frame(spark, data), block_bytes=32).collect()
    sizes = {}
    for _, t, *_ in data:
        sizes[ascii_lower(t)] = sizes.get(ascii_lower(t), 0) + 1
    want = sorted((hashlib.sha256(ascii_lower(t).encode()).hexdigest(), sizes[ascii_lower(t)]) for _, t, *_ in data)
    assert sorted((r.text_sha256, r.group_size) for r in got) == want


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = frame(spark)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    texts = [ascii_lower(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({ascii_lower(t) for _, t, *_ in rows()})


def test_empty_table(spark):
    assert exact.exact_dedup(frame(spark, [])).collect() == []
    assert exact.drop_copies(frame(spark, [])).collect() == []


def test_plan_has_no_python(spark):
    plan = exact.exact_dedup(frame(spark, rows()[:3]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
