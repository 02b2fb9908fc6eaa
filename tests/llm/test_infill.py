"""Fill-in-middle against a reading of its definition text by text."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from auditlane.llm import infill
from tests.llm.helpers import frame, rows

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text, rate=50, spm_rate=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def key(row):
    return tuple((x is None, x) for x in row)


def awkward():
    texts = ["a", " ", " a", "a ", "\t\n", "<P", "x<S>y", "<<P>>", "<P <S M>", "P>tail", "é", "日本 語\x0b", "a<", ">b c<M", "\x1c\x85  x", "<p>"]
    return [(100 * k + j, t, None, None) for k in range(30) for j, t in enumerate(texts)]


@pytest.mark.parametrize("rate,spm_rate", [(50, 80), (100, 50), (100, 0), (0, 80)])
def test_outputs_and_round_trip(spark, rate, spm_rate):
    data = rows() + awkward()
    got = infill.restore(infill.transform(frame(spark, data), rate=rate, spm_rate=spm_rate)).collect()
    want = [expected(d, t, rate, spm_rate) for d, t, *_ in data]
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    if rate == 100:
        assert {r["form"] for r in got} == ({"plain", "psm"} if spm_rate == 0 else {"plain", "psm", "spm"})


def test_empty_table(spark):
    got = infill.restore(infill.transform(frame(spark, [])))
    assert got.collect() == []
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


def test_groups_and_blocks_do_not_show(monkeypatch, spark):
    data = [(k, f"w{k} " * (k % 40), None, None) for k in range(200)]
    monkeypatch.setattr(infill, "BLOCK_BYTES", 7)
    starts = np.concatenate([[0], np.cumsum([len(t) for _, t, *_ in data])])
    assert [hi for _, hi in infill.groups(starts, 50)][-1] == len(data)
    own, places = infill.flat(pa.array([t for _, t, *_ in data]))
    ends = infill.unit_ends(own, places)
    assert len(ends) == sum(len(UNIT.findall(t)) for _, t, *_ in data)
    form = np.arange(len(data)) % 3
    form[np.diff(places) == 0] = infill.PLAIN
    out, at = infill.scatter(own, places, places[:-1], places[1:], form)
    back, again = infill.gather(out, at, form)
    assert back.tobytes() == own.tobytes() and (again == places).all()


def test_a_very_long_text_takes_little_memory():
    import tracemalloc

    text = "word and word " * 2_000_000  # 28 MB, 6 million units
    own, starts = infill.flat(pa.array([text]))
    tracemalloc.start()
    ends = infill.unit_ends(own, starts)
    form = np.array([infill.SPM])
    out, at = infill.scatter(own, starts, ends[[1000]], ends[[4_000_000]], form)
    back, _ = infill.gather(out, at, form)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert back.tobytes() == own.tobytes()
    assert peak < 6 * len(text)


def test_missing_marks_are_an_error():
    out, at = infill.flat(pa.array(["<P>a<S>b"]))
    with pytest.raises(ValueError):
        infill.gather(out, at, np.array([infill.PSM]))
