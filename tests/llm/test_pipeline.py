"""The corpus pipeline: stages keep their contracts, and the queries' SQL agrees."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from auditlane.llm import packing, queries, simhash
from tests.conftest import SF_SMALL
from tests.llm.helpers import ascii_lower, frame, rows, words


def test_stages_on_awkward_documents(spark, tmp_path):
    docs = frame(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, "unused").write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name == "language_id":
            assert docs.count() == sum(any(map(str.isalpha, t or "")) for _, t, *_ in rows())
        if name == "exact_dedup":
            assert sorted(ascii_lower(r.text) for r in docs.collect()) == sorted({ascii_lower(r.text) for r in before.collect()})
        if name == "near_dedup":
            found = {r.root: r.component_id for r in simhash.near_groups(before).collect()}
            assert sorted(map(str, (r.doc_id for r in docs.collect()))) == sorted(map(str, found.values()))
    by_bin = {}
    for r in docs.collect():
        by_bin.setdefault(r.bin, []).append(r)
    assert all(sum(r.n_words for r in b) <= packing.CAPACITY for b in by_bin.values())


def test_stages_on_an_empty_table(spark):
    empty = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "unused").collect() == [], name


def test_run_packs_what_the_mix_took(spark):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    per_doc = {}
    for r in got:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.n_words
    assert per_doc and all(n % len(words(texts[d])) == 0 and n // len(words(texts[d])) in (1, 2) for d, n in per_doc.items())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_agrees(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    said = con.execute(queries.ORACLE[name])
    names = [c[0] for c in said.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(str(r) for r in said.fetchall())
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want and want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_returns_its_contract(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    needs = {
        "op1": {"doc_id", "held_out", "score", "predicted"}, "op2": {"doc_id", "size", "source_size", "target", "taken"},
        "op3": {"doc_id", "n_words", "n_removed", "kept_sha256"}, "op4": {"doc_id", "start", "n_tokens", "ids_crc32"},
        "op5": {"doc_id", "held_out", "lang_pred", "score"}, "op6": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
        "op7": {"doc_id", "fingerprint", "component_id"}, "op8": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        "op9": {"doc_id", "bin", "n_words"}, "op10": {"query_id", "rank", "vec_id", "score"}, "op11": {"item_id", "rank", "doc_id", "score"},
        "op12": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
        "op13": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    }
    assert needs[name.split("_")[0]] <= set(got.columns)
    n = got.count()
    if name not in ("op9_packing", "op10_nearest_neighbours", "op11_lexical_search"):
        assert n == 200


def test_filtering_stages_against_plain_python(spark, tmp_path):
    """Language, exact and near dedup in a row, each on what the one before kept, by definition; then every word is packed once a copy."""
    from auditlane.llm import langid, mixing
    from tests.llm.test_simhash import brute_components, brute_print

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    table = {r.doc_id: r.text for r in docs.collect()}
    langs, scores = langid.learn(docs).predict(list(table.values()))
    told = {d: t for (d, t), lang, s in zip(table.items(), langs, scores) if lang != langid.UNDETERMINED and s >= langid.LEAST_SCORE}
    last = {}
    for d, t in told.items():
        last[ascii_lower(t)] = max(d, last.get(ascii_lower(t), d))
    single = {d: told[d] for d in last.values()}
    roots = brute_components([brute_print(t) for t in single.values()], list(single), simhash.RADIUS)
    kept = {d: single[d] for d, root in zip(single, roots) if d == root}

    found = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, (told, single, kept)):
        stage(spark, found, SF_SMALL).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        assert {r.doc_id: r.text for r in found.collect()} == want, name
        assert found.count() == len(want), name

    copies = {}
    for r in mixing.mix(found).select("doc_id").collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    packed = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_words
    assert packed == {d: n * len(words(kept[d])) for d, n in copies.items() if words(kept[d])}
