"""Documents with everything awkward in them, and plain-Python readings of the contracts."""

from __future__ import annotations

import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use inside or return
          "size long, shard int, slot int, block int, name string, row long, id long, span long, anchor long, run long, "
          "target double, taken long, cluster string, `group` int, print long, score double, kept boolean, _text string, _id long")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows():
    """(doc_id, text, lang, source): nulls, empty and blank texts, ties, repeated rows, long texts, shared passages."""
    passage = " ".join(f"shared{k}" for k in range(70))
    filler = lambda n, m: " ".join(f"w{n}x{k}" for k in range(m))
    long = " ".join(f"long{k % 997}q{k}" for k in range(9_000))
    return [
        (1, "The quick brown fox and the dog", "en", "a"),
        (2, "the QUICK brown fox and the dog", "en", "b"),
        (3, "The quick brown fox and the dog", "en", None),
        (4, None, None, "a"), (5, "", "en", "a"), (6, " \t\n ", None, None),
        (7, f"{filler(7, 30)} {passage} {filler(77, 5)}", "en", "a"),
        (8, f"{passage} {filler(8, 40)}", "en", "c"),
        (9, f"{filler(9, 3)} {passage}", None, "b"),
        (10, long, "de", "a"), (11, long + " tail", "de", "a"), (12, long.replace("long5q5 ", ""), "de", "d"),
        (13, "ÀÉ straße ÄÖ", "de", "b"), (14, "àé straße äö", "de", "b"),
        (15, "123 456 --- !!!", "en", "a"),
        (16, "word " * 400, "en", "e"), (17, "word " * 400, "en", "e"),
        (18, "a\x0bb\x0cc\rd\x1ce\x85f g", "en", "d"),
        (20, filler(20, 120), "en", "a"), (20, filler(20, 120), "en", "a"), (20, filler(21, 90), "en", "a"),
        (None, "The quick brown fox and the dog", "en", "a"), (None, filler(22, 60), None, None), (None, None, None, None),
    ]


def frame(spark, data=None):
    """The rows as a DataFrame with extra columns of clashing names; [] gives an empty table."""
    data = rows() if data is None else data
    clash = (7, 7, 7, 7, "x", 7, 7, 7, 7, 7, 7.0, 7, "x", 7, 7, 7.0, True, "x", 7)
    return spark.createDataFrame([(*r, len(r[1] or ""), *clash) for r in data], SCHEMA).repartition(3)
