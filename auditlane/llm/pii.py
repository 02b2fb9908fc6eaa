"""Personal data: high-recall candidates, gradient-boosted trees, calibrated thresholds.

1. Base spans.  Four formats (e-mail address, IP address, card number, phone number), leftmost and
   non-overlapping per kind; a match that fails its check (parts, digits, Luhn) is dropped, without another try.
2. Candidates.  Generators of high recall propose overlapping spans, also inside what the
   formats dropped: every window of up to `MAX_GROUPS` neighbouring groups of digits that has the digits of a kind;
   addresses as the format takes them, with spelled-out or spaced signs, and cut off behind the first label.
3. Features.  Small numbers of a span's format (digits, groups, first and last length, separators,
   lead, Luhn, octets) and of its context (characters beside it, cue words before it).
4. Labels.  A candidate that is a base span of its kind is a positive; one that fails a check,
   or overlaps a base span without being one, is a negative; all others carry no label: they are what the model is for.
5. Boosting.  Candidates alike in all features are one weighted cell, so the trees are learned
   from counts over the whole corpus: Newton steps of the logistic loss on at most `LEARN_CELLS` cells, the
   most frequent first.  Documents whose id hashes into the calibration fold aren't fitted to.
6. Thresholds.  Scores are made probabilities on that fold by isotonic regression; each kind's threshold is the least
   score of probability `LEAST_PROBABILITY`.
7. Selection.  Candidates over their threshold that overlap no base span, best score first,
   each kept if it overlaps none kept before.  Base spans always stay.

Everything per text is an expression of built-in functions on one row: no shuffle, no UDF.  The spans and
candidates of the table are written once (a small part of the texts); fitting shuffles cells only, and trees come back
as expressions.  All patterns take linear time and no recursion (possessive repeats, starts tied to the ends of
runs), and places come from sums over stretches of `STRETCH` matches, so a text of many matches
isn't quadratic in them (only in the spans that are added to one run of digits, or among one text's addresses).  A text's
matches are held with its row: some hundred bytes for each group of digits.

Defined cases: null and empty texts have no span; null doc_ids are documents like others; rows that repeat are documents
each; texts of any length are read whole; where nothing can be learned (no candidate, or labels of one class only)
nothing is added to the base spans; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

# The kinds in their order, and limits of their checks.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
CARD_DIGITS, PHONE_DIGITS, OCTET_MAX = (13, 19), (9, 15), 255

# The formats.  Repeats are possessive where nothing behind them could take a character back, and a match
# starts where its run of characters does (or at the end of the match before), as it would anyway.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_EDGE = rf"(?:(?<!{_LOCAL})|\G)"
FORMATS = {
    EMAIL: rf"{_EDGE}{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    IP: r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider generators of addresses, and the runs that hold all numbers.
_AT, _DOT = r"(?:\x20?@\x20?|\x20?[(\[{]\x20?at\x20?[)\]}]\x20?)", r"(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?)"
SPELLED = rf"(?i){_EDGE}{_LOCAL}++{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++)++"
SHORT = rf"{_EDGE}{_LOCAL}++@{_LABEL}++"
MAY_BE_ADDRESS = r"(?i)@|[(\[{]\x20?at\x20?[)\]}]"
RUN = r"\+?[0-9][\x20().0-9+-]*+"
LEAST_RUN = 7  # characters of the shortest span of a number, an IP address of single digits
GROUP = "[0-9]++"

# Cue words before a span.
CUES = (r"(?i)(?:e-?mail|contact|write)", r"(?i)(?:ip|host|server|addr)", r"(?i)(?:card|visa|credit|karte|carte|tarjeta)", r"(?i)(?:tel|phone|call|fax|mobil|cell)")

MAX_GROUPS = 6
CONTEXT = 24
STRETCH = 128
LEARN_CELLS = 20_000
FOLDS, CALIBRATION_FOLD = 5, 0
TREES, DEPTH, RATE, RIDGE = 20, 3, 0.4, 1.0
LEAST_PROBABILITY = 0.9
FEATURES = ("kind", "digits", "groups", "first", "last", "joint", "lead", "luhn", "octets", "left", "right", "cue")


# -- expressions ------------------------------------------------------------------------

def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _size(text: Column) -> Column:
    return F.char_length(text).cast("long")


def _before(values: Column) -> Column:
    """For each element the sum of all before it, in stretches."""

    def sums(steps: Column) -> Column:
        stretch = lambda c, n: F.slice(steps, c * STRETCH + 1, n)
        last = F.floor((F.greatest(F.size(steps), F.lit(1)) - 1) / STRETCH).cast("int")
        whole = F.transform(F.sequence(F.lit(0), last), lambda c: _sum(stretch(c, F.lit(STRETCH))))
        return _let(whole, lambda s: _let(
            F.transform(s, lambda _, c: _sum(F.slice(s, F.lit(1), c))),
            lambda offsets: F.transform(steps, lambda _, i: _let(
                F.floor(i / STRETCH).cast("int"), lambda c: F.get(offsets, c) + _sum(stretch(c, i % STRETCH))))))

    return _let(values, sums)


def located(text: Column, pattern: str, base: Column | None = None) -> Column:
    """Matches of a pattern: array of begin, end (code points, from `base`), body, left (what stands before it), right."""
    base = F.lit(0).cast("long") if base is None else base
    return _let(F.split(text, pattern, -1), lambda gaps: _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: _let(
            _before(F.transform(found, lambda m, i: _size(F.get(gaps, i)) + _size(m))), lambda before: F.transform(
                found, lambda m, i: _let(
                    base + F.get(before, i) + _size(F.get(gaps, i)), lambda begin: F.struct(
                        begin.alias("begin"), (begin + _size(m)).alias("end"), m.alias("body"),
                        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("left"),
                        F.left(F.get(gaps, i + 1), F.lit(1)).alias("right")))))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of up to 19 digits has a right check digit."""

    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).try_cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((F.char_length(digits) - i) % 2 == 1, twice).otherwise(digit).cast("long")

    few = F.char_length(digits).between(1, CARD_DIGITS[1])
    return F.when(few, _sum(F.transform(F.sequence(F.lit(1), F.char_length(digits)), value)) % 10 == 0).otherwise(F.lit(False))


def octet(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.char_length(bare) == 0) | ((F.char_length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(999)) <= OCTET_MAX))


CHECKS: dict[int, Callable[[Column], Column]] = {
    EMAIL: lambda body: F.lit(True),
    IP: lambda body: F.forall(F.split(body, r"\.", -1), octet),
    CARD: lambda body: _let(_digits(body), lambda d: F.char_length(d).between(*CARD_DIGITS) & luhn(d)),
    PHONE: lambda body: F.char_length(_digits(body)).between(*PHONE_DIGITS),
}


def base_spans(text: Column, kind: int, base: Column | None = None) -> Column:
    passed = F.filter(located(text, FORMATS[kind], base), lambda m: CHECKS[kind](m["body"]))
    return F.transform(passed, lambda m: F.struct(F.lit(kind).alias("kind"), m["begin"].alias("begin"), m["end"].alias("end")))


def _beside(letter: Column) -> Column:
    """Class of one character: 0 none, 1 letter, 2 white space, 3 other."""
    return F.when(F.coalesce(letter, F.lit("")) == "", 0).when(letter.rlike(r"[\p{L}\p{N}_]"), 1).when(letter.rlike(r"\s"), 2).otherwise(3)


def _cue(left: Column) -> Column:
    return reduce(lambda found, k: F.when(left.rlike(CUES[k]), k + 1).otherwise(found), reversed(range(len(CUES))), F.lit(0))


def _candidate(begin: Column, end: Column, **features: Column) -> Column:
    return F.struct(begin.alias("begin"), end.alias("end"), *[F.coalesce(features[f].cast("int"), F.lit(0)).alias(f) for f in FEATURES])


def _few(length: Column, most: int = 9) -> Column:
    return F.least(length, F.lit(most))


def _address(m: Column) -> Column:
    """A located address as a candidate."""
    parts = F.split(m["body"], rf"(?i){_AT}|{_DOT}", -1)
    zero = F.lit(0)
    return _let(parts, lambda p: _candidate(
        m["begin"], m["end"], kind=F.lit(EMAIL), digits=zero, groups=_few(F.size(F.split(F.regexp_replace(m["body"], rf"(?i)^.*?{_AT}", ""), rf"(?i){_DOT}", -1))),
        first=_few(F.char_length(F.get(p, zero))), last=_few(F.char_length(F.element_at(p, -1))),
        joint=m["body"].rlike(r"[\x20(\[{]"), lead=zero, luhn=zero, octets=zero,
        left=_beside(F.right(m["left"], F.lit(1))), right=_beside(m["right"]), cue=_cue(m["left"])))


def _windows(run: Column) -> Column:
    """Candidates of a run of digits and signs: windows of neighbouring groups that have the digits of a kind."""
    gaps, found = F.split(run["body"], GROUP, -1), F.regexp_extract_all(run["body"], F.lit(GROUP), F.lit(0))

    def window(groups: Column, gaps: Column, before: Column, i: Column, w: Column) -> Column:
        own, joints = F.slice(groups, i + 1, w), F.slice(gaps, i + 2, w - 1)
        lead = F.right(F.get(gaps, i), F.lit(1))
        begin = run["begin"] + F.get(before, i) + _size(F.get(gaps, i))
        behind = i + w == F.size(groups)
        return F.struct(
            begin.alias("begin"), (run["begin"] + F.get(before, i + w - 1) + _size(F.get(gaps, i + w - 1)) + _size(F.get(groups, i + w - 1))).alias("end"),
            F.array_join(own, "").alias("digits"), F.array_join(joints, "|").alias("joints"), w.alias("groups"),
            _size(F.get(groups, i)).alias("first"), _size(F.get(groups, i + w - 1)).alias("last"),
            F.when(lead == "+", 1).when(lead == "(", 2).otherwise(0).alias("lead"),
            F.forall(own, octet).alias("octets"),
            F.when((i == 0) & (F.char_length(F.get(gaps, i)) <= 1), F.right(run["left"], F.lit(1))).otherwise(
                F.right(F.get(gaps, i), F.lit(1))).alias("left"),
            F.when(behind & (F.get(gaps, i + w) == ""), run["right"]).otherwise(F.left(F.get(gaps, i + w), F.lit(1))).alias("right"))

    def of_kinds(x: Column) -> Column:
        n = F.char_length(x["digits"])
        joint = (F.when(x["joints"].rlike(r"^\|*$"), 0).when(x["joints"].rlike(r"^(?:\x20\|?)*$"), 1).when(x["joints"].rlike(r"^(?:-\|?)*$"), 2)
                 .when(x["joints"].rlike(r"^(?:\.\|?)*$"), 3).when(x["joints"].rlike("[()]"), 4).otherwise(5))
        signed = x["begin"] - F.when(x["lead"] > 0, 1).otherwise(0)

        def of(kind: int, begin: Column) -> Column:
            return _candidate(begin, x["end"], kind=F.lit(kind), digits=n, groups=x["groups"], first=_few(x["first"], 20), last=_few(x["last"], 20), joint=joint,
                              lead=x["lead"], luhn=luhn(x["digits"]), octets=x["octets"], left=_beside(x["left"]), right=_beside(x["right"]), cue=_cue(run["left"]))

        return F.filter(F.array(
            F.when((x["groups"] == 4) & (x["joints"] == ".|.|."), of(IP, x["begin"])),
            F.when(n.between(*CARD_DIGITS) & x["joints"].rlike(r"^(?:[\x20-](?:\||$))*$"), of(CARD, x["begin"])),
            F.when(n.between(*PHONE_DIGITS) & x["joints"].rlike(r"^(?:[\x20().-]{1,3}(?:\||$))*$"), of(PHONE, signed))), lambda c: c.isNotNull())

    def all_of(groups: Column, gaps: Column, before: Column) -> Column:
        windows = F.flatten(F.transform(groups, lambda _, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(MAX_GROUPS), F.size(groups) - i)), lambda w: window(groups, gaps, before, i, w))))
        likely = F.filter(windows, lambda x: F.char_length(x["digits"]).between(PHONE_DIGITS[0], CARD_DIGITS[1]) | (x["joints"] == ".|.|."))
        return F.flatten(F.transform(likely, of_kinds))

    return _let(gaps, lambda g: _let(found, lambda f: _let(
        _before(F.transform(f, lambda m, i: _size(F.get(g, i)) + _size(m))), lambda before: all_of(f, g, before))))


def _overlap(a: Column, b: Column) -> Column:
    return (a["begin"] < b["end"]) & (b["begin"] < a["end"])


def _near(spans: Column, c: Column) -> Column:
    """Of spans in order, none overlapping another, the last that begins before `c` ends: by halving."""
    n = F.size(spans)
    start = F.struct(F.lit(0).alias("low"), n.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        before = (s["low"] < s["high"]) & (F.get(spans, middle)["begin"] < c["end"])
        return F.struct(F.when(before, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(before | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"))

    steps = F.sequence(F.lit(0), F.floor(F.log2(n + 1)).cast("int"))
    return F.when(n > 0, F.get(spans, F.aggregate(steps, start, halve, lambda s: s["low"] - 1)))


def _labelled(candidates: Column, *base: Column) -> Column:
    """Candidates with `label` (1, 0 or none) and `free`: they overlap no base span.  `base`: in order, an array a kind."""

    def one(c: Column) -> Column:
        hits = F.filter(F.array(*[_near(b, c) for b in base]), lambda b: b.isNotNull() & (b["end"] > c["begin"]))
        fails = ((c["kind"] == CARD) & (c["luhn"] == 0)) | ((c["kind"] == IP) & (c["octets"] == 0))

        def judged(hits: Column) -> Column:
            same = F.exists(hits, lambda b: (b["kind"] == c["kind"]) & (b["begin"] == c["begin"]) & (b["end"] == c["end"]))
            free = F.size(hits) == 0
            return F.struct(*[c[x].alias(x) for x in ("begin", "end", *FEATURES)], free.alias("free"),
                            F.when(same, 1).when(~free | fails, 0).alias("label"))

        return _let(hits, judged)

    return F.transform(candidates, one)


def propose(docs: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """`keep`, base (spans by kind and place), parts (candidates, in groups that can't overlap one another)."""
    none = F.array()
    span, found = "array<struct<kind:int,begin:bigint,end:bigint>>", "array<struct<begin:bigint,end:bigint,body:string,left:string,right:string>>"
    text, sign = F.col("_text"), F.contains("_text", F.lit("@"))
    located_if = lambda when, pattern: F.when(when, located(text, pattern)).otherwise(none.cast(found))
    plain = lambda m: ~m["body"].rlike(FORMATS[EMAIL])
    first = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("_text")).select(
        *keep,
        located_if(sign, FORMATS[EMAIL]).alias("_emails"), located_if(sign, SHORT).alias("_short"),
        F.filter(located_if(text.rlike(MAY_BE_ADDRESS), SPELLED), plain).alias("_spelled"),
        F.filter(located_if(text.rlike("[0-9]"), RUN), lambda r: F.char_length(r["body"]) >= LEAST_RUN).alias("_runs"))
    second = first.select(
        *keep, F.concat("_emails", "_short", "_spelled").alias("_addresses"),
        F.transform("_emails", lambda m: F.struct(F.lit(EMAIL).alias("kind"), m["begin"].alias("begin"), m["end"].alias("end"))).cast(span).alias("_emails"),
        F.transform("_runs", lambda r: F.struct(*[base_spans(r["body"], k, r["begin"]).alias(KINDS[k]) for k in (IP, CARD, PHONE)],
                                                _windows(r).alias("candidates"))).alias("_runs"))
    emails, numbers = F.col("_emails"), lambda r: [r[KINDS[k]] for k in (IP, CARD, PHONE)]
    parts = F.concat(
        F.array(_labelled(F.transform("_addresses", _address), emails)),
        F.transform("_runs", lambda r: _labelled(r["candidates"], emails, *numbers(r))))
    base = F.array_sort(F.concat(emails, F.flatten(F.transform("_runs", lambda r: F.concat(*numbers(r))))))
    return second.select(*keep, base.alias("base"), F.filter(parts, lambda p: F.size(p) > 0).alias("parts"))


# -- boosted trees ----------------------------------------------------------------------

@dataclass
class Trees:
    """Sums of trees over small whole numbers; a tree is a leaf's value or (feature, limit, at most, above)."""

    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)  # by kind; none: nothing of it is added

    def scores(self, x: np.ndarray) -> np.ndarray:
        def walk(tree, rows: np.ndarray, out: np.ndarray) -> None:
            if not isinstance(tree, tuple):
                out[rows] += tree
                return
            k, limit, low, high = tree
            under = x[rows, k] <= limit
            walk(low, rows[under], out)
            walk(high, rows[~under], out)

        out = np.zeros(len(x))
        for tree in self.trees:
            walk(tree, np.arange(len(x)), out)
        return out

    def expression(self, row: Column) -> Column:
        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            k, limit, low, high = tree
            return F.when(row[FEATURES[k]] <= limit, of(low)).otherwise(of(high))

        return reduce(add, [of(t) for t in self.trees], F.lit(0.0))

    def selects(self, row: Column, score: Column) -> Column:
        over = [(row["kind"] == kind) & (score >= limit - 1e-9) for kind, limit in sorted(self.thresholds.items())]
        return reduce(lambda a, b: a | b, over, F.lit(False))


def _grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int):
    """A tree of Newton steps: the split of greatest gain at each node."""
    g, h = slope[rows].sum(), curve[rows].sum()
    best = (1e-6, None, None)
    for k in range(x.shape[1]) if depth else ():
        values, place = np.unique(x[rows, k], return_inverse=True)
        low_g, low_h = (np.cumsum(np.bincount(place, v[rows], len(values)))[:-1] for v in (slope, curve))
        gain = low_g ** 2 / (low_h + RIDGE) + (g - low_g) ** 2 / (h - low_h + RIDGE) - g ** 2 / (h + RIDGE)
        if len(gain) and gain.max() > best[0] + 1e-9:
            best = (gain.max(), k, int(values[gain.argmax()]))
    if best[1] is None:
        return RATE * g / (h + RIDGE)
    _, k, limit = best
    under = x[rows, k] <= limit
    return k, limit, _grow(x, slope, curve, rows[under], depth - 1), _grow(x, slope, curve, rows[~under], depth - 1)


def boost(x: np.ndarray, good: np.ndarray, bad: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees for cells `x` that hold `good` positives and `bad` negatives each."""
    model, score = Trees(), np.zeros(len(x))
    if not good.sum() or not bad.sum():
        return model
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, good * (1 - p) - bad * p, (good + bad) * p * (1 - p), np.arange(len(x)), depth)
        model.trees.append(tree)
        score += Trees([tree]).scores(x)
    return model


def isotonic(scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending scores, and rising probabilities fitted to their counts (pooled where they fall)."""
    ordered, place = np.unique(scores, return_inverse=True)
    pools: list[list[float]] = []  # good, all, how many scores
    for g, n in zip(np.bincount(place, good, len(ordered)), np.bincount(place, good + bad, len(ordered))):
        pools.append([g, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return ordered, np.repeat([g / n for g, n, _ in pools], [k for *_, k in pools])


def calibrate(model: Trees, x: np.ndarray, good: np.ndarray, bad: np.ndarray, least: float = LEAST_PROBABILITY) -> Trees:
    """Thresholds by kind, from the cells' counts in the calibration fold."""
    scores = model.scores(x)
    for kind in range(len(KINDS)) if model.trees else ():
        own = (x[:, 0] == kind) & (good + bad > 0)
        if good[own].sum():
            ordered, probability = isotonic(scores[own], good[own], bad[own])
            if probability[-1] >= least:
                model.thresholds[kind] = float(ordered[np.argmax(probability >= least)])
    return model


def learn(proposed: DataFrame, id_col: str = "doc_id", learn_cells: int = LEARN_CELLS) -> Trees:
    """Boosted trees and thresholds from the labelled candidates of all documents, as counts of cells."""
    held = F.coalesce(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(FOLDS)) == CALIBRATION_FOLD, F.lit(False))
    each = proposed.select(held.alias("held"), F.explode(F.flatten("parts")).alias("c")).where("c.label is not null")
    counts = {f"{name}_{fold}": F.count_if((F.col("c.label") == label) & (F.col("held") == F.lit(fold == "held")))
              for name, label in (("good", 1), ("bad", 0)) for fold in ("fit", "held")}
    cells = each.groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()])
    rows = cells.orderBy(F.col("n").desc(), *FEATURES).limit(learn_cells).collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows], dtype=np.int64).reshape(len(rows), len(FEATURES))
    good, bad, good_held, bad_held = (np.array([r[k] for r in rows], dtype=np.float64) for k in ("good_fit", "bad_fit", "good_held", "bad_held"))
    return calibrate(boost(x, good, bad), x, good_held, bad_held)


# -- spans ------------------------------------------------------------------------------

def _chosen(part: Column, model: Trees) -> Column:
    """Candidates over their thresholds that overlap no base span, best first, none overlapping another."""
    rated = F.transform(F.filter(part, lambda c: c["free"]), lambda c: _let(model.expression(c), lambda s: F.struct(
        (-s).alias("rank"), c["begin"].alias("begin"), (-c["end"]).alias("back"), c["kind"].alias("kind"), model.selects(c, s).alias("over"))))
    order = F.array_sort(F.filter(rated, lambda r: r["over"]))
    span = F.transform(order, lambda r: F.struct(r["kind"].alias("kind"), r["begin"].alias("begin"), (-r["back"]).alias("end")))
    none = F.array().cast("array<struct<kind:int,begin:bigint,end:bigint>>")
    return F.aggregate(span, none, lambda kept, s: F.when(F.exists(kept, lambda k: _overlap(k, s)), kept).otherwise(F.concat(kept, F.array(s))))


def select_spans(proposed: DataFrame, model: Trees) -> DataFrame:
    """`added` (spans the model selects) and `spans` (base and added, by kind and place) beside base."""
    added = (F.array_sort(F.flatten(F.transform("parts", lambda p: _chosen(p, model)))) if model.thresholds
             else F.array().cast("array<struct<kind:int,begin:bigint,end:bigint>>"))
    kept = [c for c in proposed.columns if c != "parts"]
    out = proposed.select(*kept, added.alias("added"))
    return out.withColumn("spans", F.array_sort(F.concat("base", "added")))


def find(docs: DataFrame, scratch: Scratch, keep: Sequence[str] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data: `keep`, base, added and spans, arrays of (kind, begin, end) in code points.

    `keep` names columns of `docs`, the id among them; with the text in it, `redacted` can follow.
    """
    proposed = scratch.write(propose(docs, keep, text_col), "candidates")
    return select_spans(proposed, learn(proposed, id_col))


def as_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["begin"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with `<kind>` in place of its spans; of spans that overlap, the first and what reaches behind it."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    placed = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        piece = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["begin"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), F.concat(state["out"], F.array(piece, F.get(names, s["kind"]))).alias("out"))

    tail = lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.char_length(text)))
    return F.aggregate(placed, start, step, tail)
