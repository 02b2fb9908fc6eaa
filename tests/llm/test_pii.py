"""Personal data: base spans against Python's own matching, planted cases, and the parts of the model by brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlane.llm import pii
from auditlane.llm.common import Scratch
from tests.llm.helpers import frame, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, body):
    digits = re.sub("[^0-9]", "", body)
    if kind == "ip":
        return all(int(p) <= 255 for p in body.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group(0))]


def spans(items):
    return [(pii.KINDS[s["kind"]], s["begin"], s["end"]) for s in items]


def card(rng):
    while True:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn(digits):
            return digits


def no_card(rng):
    digits = card(rng)
    return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)


def planted(n=300):
    """Documents with personal data among words, also side by side, and documents that only look like it."""
    rng, out = random.Random(5), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    ip = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))
    mail = lambda: f"{word()}.{rng.randint(10, 99)}@{word()}.example.com"
    for k in range(n):
        made = [rng.choice([phone, ip, mail, lambda: card(rng)])() for _ in range(rng.randint(1, 3))]
        text = " ".join(f"{word()} {word()} {m} {word()}" for m in made)
        out.append((k, text, None, None))
    for k in range(n, 2 * n):
        junk = [word() for _ in range(20)] + ["version 2.0.1", "4.0.", no_card(rng), f"{rng.randint(256, 999)}.1.1.1", "a @ b"]
        rng.shuffle(junk)
        out.append((k, " ".join(junk), None, None))
    return out


def test_base_spans_are_the_formats(spark):
    rng = random.Random(1)
    letters = ["a", "b.c", "@", ".", "-", "+", "(", ")", " ", "1", "23", "4567", "255", "256", "0001", "é", "_", "%", "\t", "+1", "4111 1111 1111 1111", "x@y.z"]
    data = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))), None, None) for k in range(1500)]
    data += [(2000 + k, t, None, None) for k, t in enumerate([
        "a@b.c_d@e.f", "a@b..c@d.e", "1.2.3.4.5.6.7.8", "1.2.3.4444", "++12345678901", "+1+234567890", "4111-1111-1111-1111.", "@x.y", "日本4111111111111111語a@b.cd𝒳 1.1.1.1"])]
    data += rows()
    found = pii.propose(frame(spark, data), ["doc_id", "text"]).collect()
    assert len(found) == len(data)
    for r in found:
        assert spans(r["base"]) == sorted(base(r["text"]), key=lambda s: (list(PATTERNS).index(s[0]), *s[1:])), r["text"]


def test_what_stands_beside_another_is_found(spark):
    rng = random.Random(9)
    one, two = card(rng), card(rng)
    beside = [(9000, f"of +1 (269) 555-3296 {one} and", None, None), (9001, f"by {two} 27.109.211.155 on", None, None),
              (9002, "write to some.one (at) mail3.example (dot) com today", None, None), (9003, "of 2669109448945251 on", None, None)]
    got = {r["doc_id"]: spans(r["spans"]) for r in pii.find(frame(spark, planted() + beside), Scratch(spark, "pii")).collect()}
    assert got[9000] == [("card", 21, 37), ("phone", 3, 20)]
    assert got[9001] in ([("ip", 20, 34), ("card", 3, 19)], [("ip", 20, 34), ("card", 3, 22)])  # the longer one where it happens to pass Luhn
    assert got[9002] == [("email", 9, 46)]
    assert got[9003] == []
    for d, text, *_ in planted():
        assert set(base(text)) <= set(got[d])
        if d >= 300:
            assert set(got[d]) == set(base(text)), text  # nothing is added to clean documents


def test_defined_cases(spark):
    got = pii.find(frame(spark), Scratch(spark, "pii"), keep=["doc_id", "text"]).collect()
    assert sorted((r["text"] is None, r["text"] or "") for r in got) == sorted((t is None, t or "") for _, t, *_ in rows())
    assert all(spans(r["spans"]) == [] for r in got)  # nothing to learn from
    assert pii.find(frame(spark, []), Scratch(spark, "pii")).collect() == []
    null_id = pii.find(frame(spark, [(None, "a@b.cd", None, None), (1, "a@b.cd", None, None), (1, "a@b.cd", None, None)]), Scratch(spark, "pii")).collect()
    assert [spans(r["spans"]) for r in null_id] == [[("email", 0, 6)]] * 3


LONG = {"a" * 300_000: 0, "1" * 300_000: 0, "1 " * 150_000: 0, "a." * 150_000 + "@": 0, "a@" * 100_000: 0, "+1" * 150_000: 0,
        "1." * 150_000: 37_500, "a@b.c " * 30_000: 30_000, "1.2.3.4 " * 10_000: 10_000, "(" * 200_000: 0}


def test_long_texts_take_linear_time(spark):
    """Plain matching of these formats would be quadratic in most of them, or overflow the stack."""
    began = time.time()
    found = pii.propose(frame(spark, [(k, t, None, None) for k, t in enumerate(LONG)]), ["doc_id"])
    assert [r["n"] for r in found.select("doc_id", F.size("base").alias("n")).orderBy("doc_id").collect()] == list(LONG.values())
    assert time.time() - began < 90


def test_redacted(spark):
    text = "ask é a@b.cd or 1.1.1.1 now"
    found = pii.find(frame(spark, [(1, text, None, None)]), Scratch(spark, "pii"), keep=["doc_id", "text"])
    assert found.select(pii.redacted(F.col("text"), F.col("spans")).alias("t")).first()["t"] == "ask é <email> or <ip> now"


def test_a_tree_is_the_best_of_all_splits():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, (60, 3))
    good, bad = rng.integers(0, 9, 60).astype(float), rng.integers(0, 9, 60).astype(float)
    model = pii.boost(x, good, bad, trees=1, depth=1)
    k, limit, low, high = model.trees[0]
    slope, curve = (good - bad) / 2, (good + bad) / 4

    def gain(k, limit):
        total = 0.0
        for side in (x[:, k] <= limit, x[:, k] > limit):
            total += slope[side].sum() ** 2 / (curve[side].sum() + pii.RIDGE)
        return total

    best = max(itertools.product(range(3), range(4)), key=lambda c: gain(*c))
    assert gain(k, limit) == pytest.approx(gain(*best))
    side = x[:, k] <= limit
    assert low == pytest.approx(pii.RATE * slope[side].sum() / (curve[side].sum() + pii.RIDGE))
    loss = lambda s: (good * np.log1p(np.exp(-s)) + bad * np.log1p(np.exp(s))).sum()
    many = pii.boost(x, good, bad, trees=12)
    losses = [loss(pii.Trees(many.trees[:n]).scores(x)) for n in range(13)]
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_isotonic_is_the_least_squares_rise():
    scores = np.array([1.0, 2, 3, 4, 5, 3])
    good, bad = np.array([0.0, 3, 1, 8, 7, 0]), np.array([4.0, 1, 3, 2, 3, 2])
    ordered, p = pii.isotonic(scores, good, bad)
    assert list(ordered) == [1, 2, 3, 4, 5] and (np.diff(p) >= 0).all()
    # pools of neighbours: 2 and 3 (4 of 10), 4 and 5 (15 of 20)
    assert p == pytest.approx([0, 0.4, 0.4, 0.75, 0.75])


def test_expression_and_arrays_agree(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 4, (80, len(pii.FEATURES)))
    model = pii.boost(x, rng.integers(0, 5, 80).astype(float), rng.integers(0, 5, 80).astype(float))
    table = spark.createDataFrame([tuple(map(int, r)) for r in x], ", ".join(f"{f} int" for f in pii.FEATURES))
    got = table.select(model.expression(F.struct(*pii.FEATURES)).alias("s")).toPandas()["s"]
    assert np.allclose(got, model.scores(x))


def test_query_columns(spark):
    from auditlane.llm.queries import op13_personal_data

    got = {r["doc_id"]: r for r in op13_personal_data(spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        want = base(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(want, key=lambda s: (pii.KINDS.index(s[0]), s[1])))
        assert got[d]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(got[d]["spans"].split(","))
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
