"""Jump consistent hashing against its recurrence in exact integers."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from auditlane.llm import sharding
from tests.llm.helpers import frame, rows


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2147483648 / ((key >> 33) + 1)))
    return b


def test_recurrence():
    keys = np.random.default_rng(1).integers(0, 2**64, 3_000, dtype=np.uint64)
    keys[:4] = [0, 1, 2**63, 2**64 - 1]
    for shards in (1, 2, 24, 25, 1_000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k), shards) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump_hash(keys, 0)


def test_one_more_shard_takes_rows_only_into_itself_and_shares_are_even():
    keys = np.random.default_rng(2).integers(0, 2**64, 60_000, dtype=np.uint64)
    now, grown = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    assert set(grown[now != grown].tolist()) == {24}
    assert 0.8 / 25 < (now != grown).mean() < 1.2 / 25
    assert np.bincount(now).min() > 0.9 * 60_000 / 24


def test_awkward_documents(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 1)  # several buckets a shard
    got = sharding.shard_documents(frame(spark), shards=3).collect()
    data = rows()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    homes = {}
    for r in got:
        homes.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 3)
    assert all(len(h) == 1 for h in homes.values())


def test_empty_table_and_files(spark, tmp_path):
    assert sharding.shard_documents(frame(spark, [])).collect() == []
    docs = spark.range(50).withColumnRenamed("id", "doc_id")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r.shard for r in back.collect()} <= {0, 1, 2, 3}


def test_a_repeated_row_is_counted_and_dealt_out_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    data = [(7, "same", "en", "a")] * 3_000 + [(7, f"other {k}", "en", "a") for k in range(500)]
    got = sharding.shard_documents(frame(spark, data), shards=2).collect()
    assert sorted(r.slot for r in got) == list(range(3_500)) and len({r.shard for r in got}) == 1
    copies = sorted(r.slot for r in got if r.text_crc32 == zlib.crc32(b"same"))
    assert copies == list(range(copies[0], copies[0] + 3_000))


def test_slots_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    data = [(k % 700, f"text {k % 900}", "en", "a") for k in range(2_000)]
    docs = frame(spark, data)
    found = [sorted(tuple(r) for r in sharding.shard_documents(docs.repartition(n)).collect()) for n in (3, 7, 1)]
    assert found[0] == found[1] == found[2]
