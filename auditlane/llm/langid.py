"""Language identification in two steps: the family, then the language inside it.

A text is its hashed byte n-grams (one to three bytes of the lower-cased text, marked at word
borders), as square roots of their shares.  A softmax model tells the language families
apart; inside a family, one linear support vector machine for each pair of languages votes
(ties go to the larger sum of margins).  Families are learned: a softmax model of the languages themselves is fitted to
either half of the sample and asked for the other; languages that it takes for each other in a share of
`CONFUSED` or more are one family, and so are those that `FAMILIES`, the start, lists together.

Learning takes at most `LEARN_ROWS` labelled documents of each of the `MAX_LANGS` most frequent languages, those with the
smallest hashes of the doc_id, each whole and as `FRAGMENTS` short pieces (so that a title is
judged as well as a book).  The driver holds them as columns and values of what isn't zero, and fits
from these; `WIDTH` columns are made only for a batch.  Everything else covers every row and whole
texts, in Arrow batches without a shuffle; the model sent along has a fixed size for each language.

Defined cases: text null or without a letter: `und`, score 0; nothing learned: the same for
all; one language learned: that language; very long texts are read whole, as one row of a batch; null or empty `lang`: never learned from; rows
that repeat are predicted alike, and an id is learned from once (the smallest language, then text hash); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Related languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
UNDETERMINED = "und"

WIDTH = 16_384
LEAST_SCORE = 0.3  # the least of 51,282 documents of check_h was 0.37; wholly unsure between two families of two: 0.25
LEARN_ROWS = 600
FRAGMENTS = 2
FRAGMENT_WORDS = 6
SEED = 53
MAX_LANGS = 200
CONFUSED = 0.02
JUDGED_ROWS = 50  # pieces of a language that make its confusions count
CONFUSION_STEPS = 150


def vector(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams of a whole text."""
    body = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)
    body = np.where(body < 65, 32, body).astype(np.uint32)  # digits, marks and line ends part words
    spread = np.uint32(2654435761)
    two = body[:-1] * np.uint32(257) + body[1:]
    three = two[:-1] * np.uint32(257) + body[2:]
    total = np.bincount(body, minlength=256).astype(np.float64)
    total[32] = 0
    out = np.zeros(WIDTH)
    out[:256] = total[:256]
    half = (WIDTH - 256) // 2
    out[256:256 + half] += np.bincount((two * spread >> np.uint32(8)) % np.uint32(half), minlength=half)
    out[256 + half:256 + 2 * half] += np.bincount((three * spread >> np.uint32(8)) % np.uint32(half), minlength=half)
    return np.sqrt(out / max(1.0, out.sum())).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


@dataclass(frozen=True)
class Identifier:
    """Weights with the bias as last row: families by column, and one column for each pair."""

    families: list[str]
    members: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if self.families and has_letter(t)]
        for start in range(0, len(rows), 256):
            some = rows[start:start + 256]
            x = _with_bias(np.stack([vector(texts[i]) for i in some]))
            chances = _softmax(x @ self.family_weights)
            best = chances.argmax(1)
            for k, name in enumerate(self.families):
                inside = np.flatnonzero(best == k)
                if len(inside):
                    found, sure = self._within(name, x[inside])
                    for j, lang, s in zip(inside, found, sure):
                        langs[some[j]], scores[some[j]] = lang, min(1.0, float(s * chances[j, k]))
        return langs, scores

    def _within(self, family: str, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        members = self.members[family]
        votes, margins = np.zeros((len(x), len(members))), np.zeros((len(x), len(members)))
        sure = np.ones((len(x), len(members)))
        for a, b in combinations(range(len(members)), 2):
            margin = x @ self.pair_weights[members[a], members[b]]
            for side, m in ((a, margin), (b, -margin)):
                votes[:, side] += m > 0
                margins[:, side] += m
                sure[:, side] = np.minimum(sure[:, side], 1.0 / (1.0 + np.exp(-np.clip(2 * m, -30, 30))))
        order = votes + 1e-6 * np.tanh(margins)
        best = order.argmax(1)
        return [members[k] for k in best], sure[np.arange(len(x)), best]


def _with_bias(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass(frozen=True)
class Sparse:
    """Rows as (columns, values) of what isn't zero."""

    rows: list[tuple[np.ndarray, np.ndarray]]
    width: int

    @classmethod
    def of(cls, x: np.ndarray) -> Sparse:
        return cls([(at, row[at]) for row in x for at in [np.flatnonzero(row)]], x.shape[1])

    def dense(self, which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), self.width), dtype=np.float32)
        for k, i in enumerate(which):
            at, value = self.rows[i]
            out[k, at] = value
        return out


def _fit_families(x: Sparse, y: np.ndarray, classes: int, steps: int = 600, rate: float = 20.0, ridge: float = 1e-5) -> np.ndarray:
    """Softmax weights by gradient steps on batches of rows, classes weighted alike; the mean of the second half."""
    draw = np.random.default_rng(SEED)
    weights = np.zeros((x.width, classes), dtype=np.float32)
    mean = np.zeros_like(weights)
    goal = np.eye(classes, dtype=np.float32)[y]
    share = (len(y) / np.maximum(1, np.bincount(y, minlength=classes)) / classes)[y][:, None].astype(np.float32)
    order = np.zeros(0, dtype=np.int64)
    for step in range(steps if classes > 1 else 0):
        if not len(order):
            order = draw.permutation(len(y))
        some, order = order[:256], order[256:]
        part = x.dense(some)
        weights -= rate * (part.T @ ((_softmax(part @ weights) - goal[some]) * share[some] / len(some)) + ridge * weights)
        if step >= steps // 2:
            mean += weights / (steps - steps // 2)
    return mean


def _fit_pair(x: np.ndarray | Sparse, sign: np.ndarray, rounds: int = 30, cost: float = 10.0) -> np.ndarray:
    """A linear support vector machine, by dual coordinate descent on the hinge loss."""
    draw = np.random.default_rng(SEED)
    x = x if isinstance(x, Sparse) else Sparse.of(x)
    weights, alpha = np.zeros(x.width, dtype=np.float64), np.zeros(len(x.rows))
    norms = np.array([float(value @ value) for _, value in x.rows])
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(x.rows)):
            at, value = x.rows[i]
            new = min(cost, max(0.0, alpha[i] - (sign[i] * (value @ weights[at]) - 1.0) / norms[i]))
            if new != alpha[i]:
                weights[at] += (new - alpha[i]) * sign[i] * value
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights.astype(np.float32)


def confusions(x: Sparse, y: np.ndarray, classes: int) -> np.ndarray:
    """Share of each class's rows that a model of the other half of the rows takes for each class."""
    half = np.arange(len(y)) // (1 + FRAGMENTS) % 2
    counts = np.zeros((classes, classes))
    for side in (0, 1):
        own, other = np.flatnonzero(half == side), np.flatnonzero(half != side)
        if len(own) and len(other):
            weights = _fit_families(Sparse([x.rows[i] for i in own], x.width), y[own], classes, steps=CONFUSION_STEPS)
            for start in range(0, len(other), 256):
                some = other[start:start + 256]
                np.add.at(counts, (y[some], (x.dense(some) @ weights).argmax(1)), 1)
    return counts / np.maximum(1, counts.sum(1, keepdims=True))


def related(x: Sparse, names: np.ndarray) -> dict[str, str]:
    """The family of each language: those of the list, joined where languages are confused."""
    langs, y, sizes = np.unique(names, return_inverse=True, return_counts=True)
    family = {str(lang): family_of(str(lang)) for lang in langs}
    judged = sizes >= JUDGED_ROWS
    if judged.sum() > 1:
        share = confusions(x, y, len(langs))
        for a, b in combinations(np.flatnonzero(judged), 2):
            if (share[a, b] + share[b, a]) / 2 >= CONFUSED:
                one, two = sorted((family[str(langs[a])], family[str(langs[b])]))
                family = {lang: one if name == two else name for lang, name in family.items()}
    return family


def fit(x: np.ndarray | Sparse, langs: list[str]) -> Identifier:
    """Learn both steps from vectors (sparse ones with a last column of ones) and their languages."""
    if not langs:
        return Identifier([], {}, np.zeros((WIDTH + 1, 0), dtype=np.float32))
    names = np.array(langs)
    x = x if isinstance(x, Sparse) else Sparse.of(_with_bias(x))
    family = related(x, names)
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(family[lang], []).append(lang)
    families = sorted(members)
    y = np.array([families.index(family[lang]) for lang in langs])
    pairs = {}
    for group in members.values():
        for a, b in combinations(group, 2):
            rows = np.flatnonzero((names == a) | (names == b))
            pairs[a, b] = _fit_pair(Sparse([x.rows[i] for i in rows], x.width), np.where(names[rows] == a, 1.0, -1.0))
    return Identifier(families, members, _fit_families(x, y, len(families)), pairs)


def _pieces(text: str, seed: int) -> list[str]:
    """The whole text and some short runs of its words."""
    words, draw = text.split(), np.random.default_rng(seed & 0xFFFFFFFF)
    out = [text]
    for _ in range(FRAGMENTS if len(words) > 1 else 0):
        size = int(draw.integers(1, FRAGMENT_WORDS + 1))
        start = int(draw.integers(0, max(1, len(words) - size + 1)))
        out.append(" ".join(words[start:start + size]))
    return [p for p in out if has_letter(p)]


def learn(docs: DataFrame, learn_rows: int = LEARN_ROWS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Identifier:
    """Fit an `Identifier` on at most `learn_rows` documents of each language."""
    known = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.xxhash64(F.lit(SEED), F.col(id_col)).alias("_place"),
                        F.xxhash64(text_col).alias("_print"), F.col(text_col).alias("_text")).where("_lang is not null and _lang != '' and _id is not null and _text is not null")
    # One row for each id, before the limit: a repeated id takes one place.
    alone = known.groupBy("_id", "_place").agg(F.min(F.struct("_lang", "_print")).alias("_one")).select("_id", "_place", "_one.*")
    ranked = Window.partitionBy("_lang").orderBy("_place", "_id")
    # Hashes are even, so the smallest learn_rows lie far below the share that holds twice as many (and 100): few rows meet in a window.
    # Of a column with very many values, the most frequent.
    sizes = alone.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_lang").limit(MAX_LANGS)
    low = F.lit(-(2.0**63)) + F.lit(2.0**64 * (2 * learn_rows + 100)) / F.col("_n")
    alone = alone.join(F.broadcast(sizes), "_lang").where(F.col("_place").cast("double") <= low)  # MAX_LANGS rows at most
    picked = alone.withColumn("_nth", F.row_number().over(ranked)).where(F.col("_nth") <= learn_rows).select("_id", "_lang", "_print")
    # At most learn_rows ids a language: bounded by a parameter, so broadcast.
    chosen = known.join(F.broadcast(picked), ["_id", "_lang", "_print"]).select("_id", "_lang", "_text")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows of one id are alike here
        for part in parts:
            new = [r for r in zip(*(c.to_pylist() for c in part.columns)) if not (r[0] in seen or seen.add(r[0]))]
            rows = [(i, lang, k, at, x[at]) for i, lang, text in new
                    for k, p in enumerate(_pieces(text, i)) for x in [vector(p)] for at in [np.flatnonzero(x)]]
            yield pa.RecordBatch.from_pydict({
                "_id": pa.array([r[0] for r in rows], type=pa.int64()),
                "_lang": pa.array([r[1] for r in rows], type=pa.string()),
                "piece": pa.array([r[2] for r in rows], type=pa.int32()),
                "at": pa.array([r[3].astype(np.uint16).tobytes() for r in rows], type=pa.binary()),
                "value": pa.array([r[4].tobytes() for r in rows], type=pa.binary()),
            })

    made = chosen.mapInArrow(batches, "_id long, _lang string, piece int, at binary, value binary")
    rows = made.dropDuplicates(["_id", "piece"]).collect()
    rows.sort(key=lambda r: (r["_id"], r["piece"]))
    one = np.ones(1, dtype=np.float32)
    x = [(np.append(np.frombuffer(r["at"], dtype=np.uint16), np.uint16(WIDTH)), np.append(np.frombuffer(r["value"], dtype=np.float32), one))
         for r in rows]
    langs = [r["_lang"] for r in rows]
    del rows
    return fit(Sparse(x, WIDTH + 1), langs)


def identify(docs: DataFrame, model: Identifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, scores = model.predict(part.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0),
                "lang_pred": pa.array(langs, type=pa.string()),
                "score": pa.array(scores, type=pa.float64()),
            })

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).mapInArrow(
        batches, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Identifier, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is told with at least `least_score`, with all their columns.

    Where nothing was learned, those with a letter.
    """
    schema = docs.schema
    where = docs.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(where).to_pylist()
            langs, scores = model.predict(texts)
            sure = [lang != UNDETERMINED and s >= least_score for lang, s in zip(langs, scores)] if model.families else map(has_letter, texts)
            yield part.filter(pa.array(list(sure), type=pa.bool_()))

    return docs.mapInArrow(batches, schema)
