"""Quality by Bradley-Terry ranking of preference pairs.

A labelled good document is preferred to a labelled bad one.  The model gives a document
the strength s(x) = w . x and a preference the probability sigmoid(s(good) - s(bad)), so w is
learned by logistic loss on feature differences; no label enters alone.  The cut between
kept and rejected is a quantile of the strengths: the share of bad rows among all labelled
ones (or a quantile the caller names).  The score is sigmoid(s - cut + logit(0.7)), so it
rises with s and reaches 0.7 at the cut.

Features are shares and rates over the whole text (letters in capitals, marks, repeated
words and lines, ...), never labels, language, source or id.  Scales, weights and the cut come from all
labelled rows, and the weights from all pairs of a good and a bad one.  That is one pass a sum, not a
join: how a row's preferences stand depends on its strength alone, so tasks count and sum the rows by
class and by points of strength (`CELL` apart), and the driver sees a row a point.  Newton's steps begin
where a fit on `learn_rows` rows of each class, those with the smallest hashes of the doc_id, and
`pairs` pairs of them ends, and are halved while they raise the loss; the minimum that they lead to doesn't depend on it.  Features are written
once, in Arrow batches without a shuffle of texts; scoring covers every row in the same way.

Defined cases: null text is an empty one and is scored like any other; very long texts are read whole, one at a time; without rows of
both classes nothing is learned and every score is 0.5; rows that repeat a doc_id are
scored alike; of contradicting labels of a doc_id the smaller counts, and of its texts the one with the smallest hash; a null doc_id is not held out and
never learned from; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

LEARN_ROWS = 4_000
PAIRS = 100_000
KEEP_SCORE = 0.7
RIDGE = 1e-3
STEPS = 60
SEED = 71
CELL = 1 / 32
CUT_CELLS = 1024
# Labelled rows in a file of features (some 170 bytes each).
ROWS_A_FILE = 20_000

SYMBOLS = "#$%&*@^~=<>_{}[]\\/+"
NAMES = ("capitals", "digits", "shouts", "bars", "symbols", "stops", "line_ends", "adjacent_repeats",
         "vocabulary", "top_word", "word_length", "words", "repeated_lines", "other_bytes", "links", "empty",
         "some_capitals", "some_shouts", "some_bars", "some_symbols", "some_repeats")
SOON = 0.03
_LINKS = re.compile(r"https?://|www\.|\S@\S")


def features(text: str | None) -> list[float]:
    """The features named in `NAMES`, of a whole text."""
    text = text or ""
    body = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    of = lambda chars: float(counts[list(chars.encode())].sum())
    words = text.split()
    n, size = len(words), max(1, len(body))
    upper, lower = float(counts[65:91].sum()), float(counts[97:123].sum())
    common = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    per_word = 1.0 / max(1, n)
    rates = [
        upper / max(1.0, upper + lower),
        float(counts[48:58].sum()) / size,
        of("!?") * per_word,
        of("|") * per_word,
        of(SYMBOLS) / size,
        of(",.;:") * per_word,
        of("\n") * per_word,
        sum(map(eq, words, words[1:])) * per_word,
        np.log1p(len(common)) / np.log1p(n) if n else 1.0,
        max(common.values()) * per_word if n > 1 else 0.0,
        min(40.0, len(text) * per_word),
        np.log1p(n),
        1.0 - len(set(lines)) / len(lines) if lines else 0.0,
        float(counts[:32].sum() - counts[9:11].sum()) / size,
        len(_LINKS.findall(text)) * per_word if "@" in text or "www" in text or "http" in text else 0.0,
        float(n == 0),
    ]
    # A little of these tells much: the rate again, on a scale that saturates.
    return rates + [rates[k] / (rates[k] + SOON) for k in (0, 2, 3, 4, 7)]


@dataclass(frozen=True)
class Ranker:
    """Standardised linear strengths, and the strength at the cut."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float | None

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _standard(x, self.center, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.cut is None:
            return np.full(len(x), 0.5)
        at_cut = np.log(KEEP_SCORE / (1 - KEEP_SCORE))
        return 1.0 / (1.0 + np.exp(-np.clip(self.strength(x) - self.cut + at_cut, -50, 50)))


def _standard(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - center) / scale, -6, 6)


def fit_pairs(x: np.ndarray, good: np.ndarray, bad_share: float, pairs: int = PAIRS, quantile: float | None = None) -> Ranker:
    """Bradley-Terry weights from rows `x`, of which `good` are preferred to the others.

    `bad_share` is the share of bad rows among all labelled rows; the strengths are weighted
    so that their quantile is one of that population.
    """
    width = x.shape[1] if x.ndim == 2 and len(x) else len(NAMES)
    if not len(x) or good.all() or not good.any():
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), None)
    center, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = _standard(x, center, scale)
    draw = np.random.default_rng(SEED)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    difference = z[draw.choice(up, pairs)] - z[draw.choice(down, pairs)]
    weights = np.zeros(width)
    for _ in range(STEPS):  # Newton steps of the ridge-penalised logistic loss
        p = 1.0 / (1.0 + np.exp(-np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ (1.0 - p) / pairs - RIDGE * weights
        curve = (difference * (p * (1.0 - p))[:, None]).T @ difference / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    strength = z @ weights
    order = np.argsort(strength, kind="stable")
    mass = np.where(good, (1 - bad_share) / len(up), bad_share / len(down))[order]
    at = np.searchsorted(np.cumsum(mass), (bad_share if quantile is None else quantile) - 1e-9)
    ranked = strength[order]
    cut = float(ranked[min(at, len(ranked) - 1)] + ranked[min(at + 1, len(ranked) - 1)]) / 2
    return Ranker(center, scale, weights, cut)


def _apply(docs: DataFrame, text_col: str, schema: str, columns: list[str], make) -> DataFrame:
    """Batches of `columns` plus what `make(texts)` gives as further columns."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(part.schema.get_field_index("_text")).to_pylist()
            kept = {c: part.column(part.schema.get_field_index(c)) for c in columns}
            yield pa.RecordBatch.from_pydict(kept | make(texts))

    return docs.select(*columns, F.col(text_col).alias("_text")).mapInArrow(batches, schema)


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(len(texts), len(NAMES))


def _labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, good, x of each labelled document, one row for each id; features go to the labels, texts stay where they are."""
    make = lambda texts: {"x": pa.array(list(_matrix(texts)), type=pa.list_(pa.float64()))}
    read = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_print"), F.col(text_col).alias("_t"))
    made = _apply(read, "_t", "_id long, _print long, x array<double>", ["_id", "_print"], make)
    one = made.join(known, "_id").groupBy("_id").agg(F.min(F.struct("_print", "_label", "x")).alias("_one"))
    return one.select("_id", (F.col("_one._label") == 1).alias("good"), "_one.x")


def _rows_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(NAMES))
    return x, part.column(part.schema.get_field_index("good")).to_numpy(zero_copy_only=False).astype(bool)


def _summed(rows: DataFrame, width: int, make) -> dict[tuple[bool, int], np.ndarray]:
    """What `make(x, good)` gives as {(good, cell): `width` numbers}, summed over all rows: one row a class and cell comes back.

    Sums of tasks are added in the tasks' order, so that reruns agree to the last bit.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[bool, int], np.ndarray] = {}
        for part in parts:
            for key, values in make(*_rows_of(part)).items():
                total[key] = total[key] + values if key in total else values
        if total:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({
                "good": pa.array([g for g, _ in total], type=pa.bool_()), "cell": pa.array([int(c) for _, c in total], type=pa.int64()),
                "task": pa.array([task] * len(total), type=pa.int64()), "sums": pa.array([v.tolist() for v in total.values()], type=pa.list_(pa.float64()))})

    parts = rows.select("good", "x").mapInArrow(batches, "good boolean, cell long, task long, sums array<double>")
    added = F.aggregate(F.array_sort(F.collect_list(F.struct("task", "sums"))), F.array_repeat(F.lit(0.0), width),
                        lambda total, part: F.zip_with(total, part["sums"], lambda a, b: a + b))
    found = parts.groupBy("good", "cell").agg(added.alias("sums")).collect()
    return {(r["good"], r["cell"]): np.array(r["sums"]) for r in sorted(found, key=lambda r: (r["good"], r["cell"]))}


def _by_strength(s: np.ndarray, good: np.ndarray, values: np.ndarray) -> dict[tuple[bool, int], np.ndarray]:
    """Sums of the rows of `values` by class and point of strength; a row is dealt to the two points next to it, the nearer the more."""
    found, point = {}, np.floor(s / CELL)
    upper = s / CELL - point
    for kind in (True, False):
        own = good == kind
        cells, at = np.unique(np.concatenate([point[own], point[own] + 1]), return_inverse=True)
        sums = np.zeros((len(cells), values.shape[1]))
        np.add.at(sums, at, np.concatenate([values[own] * (1 - upper[own])[:, None], values[own] * upper[own][:, None]]))
        found |= {(kind, int(c)): v for c, v in zip(cells, sums)}
    return found


def _scales(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of the features over all rows."""
    width = len(NAMES)
    one = _summed(rows, width + 1, lambda x, good: {(True, 0): np.append(x.sum(0), len(x))})[True, 0]
    center = one[:-1] / one[-1]
    scale = np.sqrt(_summed(rows, width, lambda x, good: {(True, 0): ((x - center) ** 2).sum(0)})[True, 0] / one[-1])
    return center, np.where(scale > 1e-9, scale, 1.0)


def _step(rows: DataFrame, center: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """The ridge-penalised logistic loss over all pairs of a good and a bad row, and Newton's step from here."""

    def by_strength(x, good):
        z = _standard(x, center, scale)
        return _by_strength(z @ weights, good, np.column_stack([np.ones(len(z)), z]))

    cells = _summed(rows, len(NAMES) + 1, by_strength)
    at = {kind: np.array([c for k, c in cells if k == kind]) * CELL for kind in (True, False)}
    up, down = (np.array([v for (k, _), v in cells.items() if k == kind]) for kind in (True, False))
    pairs = up[:, 0].sum() * down[:, 0].sum()
    # A pair's chance to be ranked wrongly, from those at the points around its rows.
    ahead = at[True][:, None] - at[False][None, :]
    loss = up[:, 0] @ np.logaddexp(0, -ahead) @ down[:, 0] / pairs + RIDGE / 2 * weights @ weights
    wrong = 1.0 / (1.0 + np.exp(np.clip(ahead, -30, 30)))
    slope = (wrong @ down[:, 0]) @ up[:, 1:] - (up[:, 0] @ wrong) @ down[:, 1:]
    bend = wrong * (1.0 - wrong)
    crossed = up[:, 1:].T @ bend @ down[:, 1:]
    heavy = {True: bend @ down[:, 0], False: up[:, 0] @ bend}

    def squares(x, good):
        z = _standard(x, center, scale)
        s = z @ weights
        share = np.where(good, np.interp(s, at[True], heavy[True]), np.interp(s, at[False], heavy[False]))
        return {(True, 0): (z.T @ (z * share[:, None])).ravel()}

    curve = _summed(rows, len(NAMES) ** 2, squares)[True, 0].reshape(len(NAMES), len(NAMES)) - crossed - crossed.T
    return loss, np.linalg.solve(curve / pairs + RIDGE * np.eye(len(NAMES)), slope / pairs - RIDGE * weights)


def _cut(rows: DataFrame, strength, totals: dict[bool, int], bad_share: float, quantile: float) -> float:
    """The middle between the strength at the quantile and the next one, over all rows: cells are halved and counted until one holds one strength.

    Each class weighs its share of the labels.
    """
    def cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x, good = _rows_of(part)
            yield pa.RecordBatch.from_pydict({"good": pa.array(good), "s": pa.array(strength(x), type=pa.float64())})

    ranked = rows.select("good", "x").mapInArrow(cells, "good boolean, s double")
    each = {True: (1 - bad_share) / totals[True], False: bad_share / totals[False]}
    mass = lambda up, down: up * each[True] + down * each[False]
    low, high = ranked.agg(F.min("s"), F.max("s")).first()
    below, above = (0, 0), None
    while True:
        width = (high - low) / CUT_CELLS
        cell = F.least(F.floor((F.col("s") - low) / width), F.lit(CUT_CELLS - 1)) if width > 0 else F.lit(0)
        found = ranked.where(F.col("s").between(low, high)).groupBy(cell.cast("int").alias("cell")).agg(
            F.count_if("good").alias("up"), F.count_if(~F.col("good")).alias("down"), F.min("s").alias("low"), F.max("s").alias("high")).collect()
        for k, r in enumerate(found := sorted(found, key=lambda r: r["cell"])):
            reached = (below[0] + r["up"], below[1] + r["down"])
            if mass(*reached) >= quantile - 1e-9 or k == len(found) - 1:
                break
            below = reached
        above = found[k + 1]["low"] if k + 1 < len(found) else above
        if r["low"] == r["high"]:
            # Rows that share this strength: the next one is among them unless they end at the quantile.
            tied = mass(*reached) - quantile > max(each.values()) - 1e-9 and r["up"] + r["down"] > 1
            return float(r["low"] if tied or above is None else (r["low"] + above) / 2)
        low, high = r["low"], r["high"]


def learn(docs: DataFrame, labels: DataFrame, learn_rows: int = LEARN_ROWS, pairs: int = PAIRS,
          quantile: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker:
    """Fit a `Ranker` on all labelled documents; `learn_rows` of each class and `pairs` pairs of them are where it starts."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"))
    labelled = {bool(r["good"]): r["n"] for r in known.groupBy((F.col("_label") == 1).alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad_share = labelled.get(False, 0) / max(1, sum(labelled.values()))
    # Files that follow from the rows alone: sums are added in their order.
    files = -(-sum(labelled.values()) // ROWS_A_FILE) or 1
    rows = Scratch(docs.sparkSession, "quality").write(_labelled(docs, known, id_col, text_col).repartition(files, "_id").sortWithinPartitions("_id"), "features")
    place = F.xxhash64(F.lit(SEED), F.col("_id"))
    ids = [rows.where(F.col("good") == good).select("_id").orderBy(place, "_id").limit(learn_rows) for good in (True, False)]
    # At most 2 x learn_rows ids: bounded by a parameter, so broadcast.
    first = sorted(rows.join(F.broadcast(ids[0].unionByName(ids[1])), "_id").collect(), key=lambda r: r["_id"])
    good = np.array([r["good"] for r in first], dtype=bool)
    start = fit_pairs(np.array([r["x"] for r in first], dtype=np.float64).reshape(len(first), len(NAMES)), good, bad_share, pairs, quantile)
    if good.all() or not good.any():
        return start
    return fit_all(rows, bad_share, quantile, start)


def fit_all(rows: DataFrame, bad_share: float, quantile: float | None = None, start: Ranker | None = None) -> Ranker:
    """Bradley-Terry weights from all pairs of a good and a bad row of `rows` (good, x), and the cut among all of them."""
    center, scale = _scales(rows)
    weights = np.zeros(len(NAMES)) if start is None else start.weights * scale / start.scale
    loss, step = _step(rows, center, scale, weights)
    for _ in range(STEPS):
        if np.abs(step).max() < 1e-6:
            break
        tried, further = _step(rows, center, scale, weights + step)
        if tried > loss + 1e-4:
            step = step / 2  # too far
        else:
            weights, loss, step = weights + step, tried, further
    weights = weights + step
    totals = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    strength = Ranker(center, scale, weights, None).strength
    return Ranker(center, scale, weights, _cut(rows, strength, totals, bad_share, bad_share if quantile is None else quantile))


def score_documents(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    make = lambda texts: {"score": pa.array(ranker.score(_matrix(texts)), type=pa.float64())}
    return _apply(docs.withColumn("doc_id", F.col(id_col)), text_col, "doc_id long, score double", ["doc_id"], make)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold that is never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))
