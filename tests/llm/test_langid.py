"""Language identification: held-out accuracy, both steps, and the defined cases."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from auditlane.llm import langid, quality
from tests.conftest import SF_CHECK
from tests.llm.helpers import frame, rows


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    held = quality.held_out(F.col("doc_id"), 5, 0)
    model = langid.learn(docs.where(~held))
    assert model.families == ["germanic", "romance"] and set(model.pair_weights) == {("de", "en"), ("es", "fr")}
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held).collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_pair_machine_has_a_margin():
    draw = np.random.default_rng(0)
    x = langid._with_bias(np.vstack([draw.normal(1, 0.2, (40, 6)), draw.normal(-1, 0.2, (40, 6))]).astype(np.float32))
    sign = np.repeat([1.0, -1.0], 40)
    w = langid._fit_pair(x, sign)
    assert (sign * (x @ w) > 0.9).all()


def test_votes_among_several_relatives():
    langs = ["de", "en", "nl", "xx"]
    texts = {"de": "schön straße über", "en": "the thing which", "nl": "een vijf mooie", "xx": "qqq zzz qzq"}
    x = np.stack([langid.vector(texts[k] + " " * n) for k in langs for n in range(5)])
    model = langid.fit(x, [k for k in langs for _ in range(5)])
    assert model.families == ["germanic", "xx"] and len(model.pair_weights) == 3
    assert model.predict([texts[k] for k in langs])[0] == langs


def test_awkward_documents(spark):
    docs = frame(spark)
    model = langid.learn(docs)
    got = langid.identify(docs, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, *_ in rows())
    lost = sorted(str(d) for d, t, *_ in rows() if not any(map(str.isalpha, t or "")))
    assert sorted(str(r.doc_id) for r in got if r.lang_pred == "und") == lost
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows()) - len(lost)


def test_nothing_learned_one_language_and_empty_table(spark):
    untold = frame(spark, [(1, "some words", None, "a"), (2, "more", "", "a")])
    assert {(r.lang_pred, r.score) for r in langid.identify(untold, langid.learn(untold)).collect()} == {("und", 0.0)}
    one = frame(spark, [(1, "some words", "en", "a"), (2, "mehr", None, "a")])
    assert {r.lang_pred for r in langid.identify(one, langid.learn(one)).collect()} == {"en"}
    assert langid.identify(frame(spark, []), langid.learn(one)).collect() == []


def test_features_are_wide_and_the_sample_is_bounded_per_language(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    assert np.count_nonzero(langid.vector(" ".join(a + b + c for a in letters for b in letters for c in letters))) > 4_000
    monkeypatch.setattr(langid, "FRAGMENTS", 0)
    seen = []
    monkeypatch.setattr(langid, "fit", lambda x, langs: seen.append(Counter(langs)))
    langid.learn(frame(spark, [(k, f"words {k}", f"l{k % 12}", "a") for k in range(12 * 130)]))
    assert seen == [Counter({f"l{k}": 130 for k in range(12)})]


def test_unsure_documents_go_and_nothing_learned_keeps_letters(spark):
    docs = frame(spark, [(1, "some words", None, "a"), (2, "more", "", "a"), (3, "12 - 34", None, "a")])
    assert sorted(r.doc_id for r in langid.keep_identified(docs, langid.learn(docs)).collect()) == [1, 2]
    none = np.zeros(langid.WIDTH + 1, dtype=np.float32)
    unsure = langid.Identifier(["germanic", "romance"], {"germanic": ["de", "en"], "romance": ["es", "fr"]}, np.stack([none, none], axis=1),
                               {("de", "en"): none, ("es", "fr"): none})
    assert langid.keep_identified(docs, unsure).collect() == []


def test_a_repeated_id_is_learned_from_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "FRAGMENTS", 0)
    monkeypatch.setattr(langid, "fit", lambda x, langs: seen.append(Counter(langs)))
    data = [(k, f"words {k}", "en", "a") for k in range(20)] + [(5, f"more {k % 2}", "en", "a") for k in range(60)] + [(99, "mehr", "de", "a")]
    for limit in (30, 10):
        langid.learn(frame(spark, data), learn_rows=limit)
    assert seen == [Counter(en=20, de=1), Counter(en=10, de=1)]


def test_the_sample_is_the_smallest_hashes_of_each_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "FRAGMENTS", 0)
    monkeypatch.setattr(langid, "fit", lambda x, langs: seen.append((x.rows, langs)))
    docs = frame(spark, [(k, "w" * (1 + k), "en" if k % 3 else "de", "a") for k in range(900)])
    langid.learn(docs, learn_rows=20)
    place = F.xxhash64(F.lit(langid.SEED), "doc_id")
    want = {r.doc_id for lang in ("de", "en") for r in docs.where(F.col("lang") == lang).orderBy(place).limit(20).collect()}
    monkeypatch.undo()
    got = seen[0][0]
    assert len(got) == 40 and sorted(seen[0][1]) == ["de"] * 20 + ["en"] * 20
    for (at, value), k in zip(got, sorted(want)):
        assert np.allclose(langid.Sparse([(at, value)], langid.WIDTH + 1).dense(np.array([0]))[0, :-1], langid.vector("w" * (1 + k)))


def test_families_are_learned_from_confusions():
    """Two languages that no list knows, alike but for one letter in some words, become one family; a third stays apart."""
    rng = np.random.default_rng(8)
    stem = ["kala", "miru", "tono", "sede", "vulo", "paki"]

    def text(lang):
        words = rng.choice(stem, 6).tolist()
        if lang == "qc":
            return " ".join(w[::-1].upper() + "zz" for w in words)
        return " ".join(w + ("x" if lang == "qa" and rng.random() < 0.35 else "") for w in words)

    langs = [lang for _ in range(90) for lang in ("qa", "qb", "qc")]
    x = langid._with_bias(np.stack([langid.vector(text(lang)) for lang in langs]))
    model = langid.fit(langid.Sparse.of(x), langs)
    assert model.members == {"qa": ["qa", "qb"], "qc": ["qc"]} and set(model.pair_weights) == {("qa", "qb")}
    assert model.predict([text("qc") for _ in range(20)])[0] == ["qc"] * 20


def test_confusions_count_the_other_half():
    x = langid.Sparse.of(langid._with_bias(np.repeat(np.eye(3, dtype=np.float32), 60, axis=0)[np.random.default_rng(1).permutation(180)]))
    y = np.array([row[0][0] for row in x.rows])
    assert np.allclose(langid.confusions(x, y, 3), np.eye(3))
    mixed = np.where((y == 2) & (np.arange(180) % 4 == 0), 1, y)  # a quarter of 2 is labelled 1
    assert langid.confusions(x, mixed, 3)[1, 2] > 0.1


def test_pair_machine_against_brute_force():
    """The dual by coordinate descent reaches the objective that plain projected gradient steps reach."""
    draw = np.random.default_rng(6)
    x = langid._with_bias(draw.normal(size=(24, 4)).astype(np.float32)).astype(np.float64)
    sign = np.where(x[:, 0] + 0.8 * draw.normal(size=24) > 0, 1.0, -1.0)
    gram = (x * sign[:, None]) @ (x * sign[:, None]).T
    alpha, rate = np.zeros(24), 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(60_000):
        alpha = np.clip(alpha + rate * (1 - gram @ alpha), 0, 10.0)
    want = x.T @ (alpha * sign)
    loss = lambda w: 0.5 * w @ w + 10.0 * np.maximum(0, 1 - sign * (x @ w)).sum()
    got = langid._fit_pair(x, sign, rounds=4_000).astype(np.float64)
    assert loss(got) <= loss(want) * 1.01


def test_only_the_most_frequent_languages_are_learned(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "FRAGMENTS", 0)
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    monkeypatch.setattr(langid, "fit", lambda x, langs: seen.append(Counter(langs)))
    langid.learn(frame(spark, [(k, f"words {k}", "aabbbc"[k % 6], "a") for k in range(60)]))
    assert seen == [Counter(b=30, a=20)]
