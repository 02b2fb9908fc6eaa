"""Fill-in-middle transformation by displacement scatter.

A text is cut into units (white space and the word behind it; a white-space tail is one too).
Two draws of the document's id give two cuts, and the pieces are dealt anew, with marks between:

    plain   the text, unchanged
    psm     <P> prefix <S> suffix <M> middle
    spm     <S> suffix <P> prefix <M> middle

No text is cut out or joined by itself.  The texts of a batch are one array of bytes.  A scan of it
finds the cuts; each piece has one displacement, which a difference array holds at the
piece's first byte; its cumulative sum is the displacement of every byte, and one numpy scatter
per block of bytes writes the outputs of the whole batch.  `restore` is the inverse: it scans an output for
its three marks and gathers the text by displacements of its own.

White space here is ASCII, so cuts on UTF-8 bytes are cuts between code points.  Spark deals the
rows; there is no shuffle.  A task works on groups of `GROUP_BYTES` (a longer text is a group by
itself) and sums displacements in blocks of `BLOCK_BYTES`: a group takes some 4 times its bytes, and
8 more for each of its units.

Defined cases: null text is an empty one, and plain; so is a text that holds a mark; a null
doc_id draws as the empty text; rows that repeat a doc_id draw alike; very long texts are
one group; cuts may leave any piece empty; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks, the seed of the draws, percent of documents transformed, percent of those in spm.
MARKS = ("<P>", "<S>", "<M>")
SEED = 42
RATE = 50
SPM_RATE = 80
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")

GROUP_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
MARK_BYTES = len(MARKS[0])

TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from sha256 of `seed:doc_id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


# -- arrays of bytes --------------------------------------------------------------------

def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where its texts start, with the end of the last; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]], starts - starts[0]


def as_text(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data))


def groups(starts: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together, one text at least."""
    lo, n = 0, len(starts) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def unit_ends(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units end, in all texts: behind a word, and at the end of a text."""
    space = _SPACE[data]
    ends = np.zeros(len(data), dtype=bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[starts[1:][starts[1:] > starts[:-1]] - 1] = True
    return np.flatnonzero(ends) + 1


def find_marks(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of marks that lie inside one text, ascending, and their texts."""
    at = np.flatnonzero(data == ord("<"))
    at = at[at + MARK_BYTES <= len(data)]
    at = at[(data[at + 2] == ord(">")) & np.isin(data[at + 1], [ord(m[1]) for m in MARKS])]
    text = np.searchsorted(starts, at, "right") - 1
    inside = at + MARK_BYTES <= starts[text + 1]
    return at[inside], text[inside]


def displacements(at: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of the places 0 to size: the places, and their displacements.

    `shift[k]` holds from place `at[k]` (ascending; of equal ones the last) to the next.
    """
    step, sofar = np.diff(shift, prepend=0), 0
    for lo in range(0, size, BLOCK_BYTES):
        hi = min(lo + BLOCK_BYTES, size)
        i, j = np.searchsorted(at, [lo, hi])
        difference = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(difference, at[i:j] - lo, step[i:j])
        difference[0] += sofar
        moved = np.cumsum(difference)
        sofar = moved[-1]
        yield np.arange(lo, hi), moved


def _pieces(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def scatter(data: np.ndarray, starts: np.ndarray, cut: np.ndarray, end: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of all texts, and where they start: prefixes end at `cut`, middles at `end`."""
    begin, stop = starts[:-1], starts[1:]
    dealt = form != PLAIN
    room = np.where(dealt, 3 * MARK_BYTES, 0)
    places = np.concatenate([[0], np.cumsum(stop - begin + room)])
    to, head, tail = places[:-1], cut - begin, stop - end
    first, second = MARK_BYTES, 2 * MARK_BYTES
    prefix = np.select([form == PSM, form == SPM], [to + first, to + second + tail], to)
    suffix = np.select([form == PSM, form == SPM], [to + second + head, to + first], to + (end - begin))
    middle = np.where(dealt, to + room + head + tail, to + head)
    out = np.empty(places[-1], dtype=np.uint8)
    for place, moved in displacements(_pieces(begin, cut, end), _pieces(prefix - begin, middle - cut, suffix - end), len(data)):
        out[place + moved] = data[place]
    for mark, before in zip(MARKS, (prefix, suffix, middle)):
        for k, letter in enumerate(mark.encode()):
            out[before[dealt] - MARK_BYTES + k] = letter
    return out, places


def gather(out: np.ndarray, places: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts again, from outputs and forms alone."""
    to, stop = places[:-1], places[1:]
    dealt = np.flatnonzero(form != PLAIN)
    at, text = find_marks(out, places)
    at = at[form[text] != PLAIN]
    if len(at) != 3 * len(dealt):
        raise ValueError("an output has not the three marks of its form")
    one, two, three = at.reshape(-1, 3).T
    sizes = (stop - to) - np.where(form != PLAIN, 3 * MARK_BYTES, 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    begin, psm = starts[:-1], form[dealt] == PSM
    # Where the pieces of the text stand in the output; a plain text is all prefix.
    prefix, middle, suffix = to.copy(), to.copy(), to.copy()
    head, tail = sizes.copy(), np.zeros_like(sizes)
    before, behind = two - one - MARK_BYTES, three - two - MARK_BYTES
    head[dealt], tail[dealt] = np.where(psm, before, behind), np.where(psm, behind, before)
    prefix[dealt] = np.where(psm, one, two) + MARK_BYTES
    suffix[dealt] = np.where(psm, two, one) + MARK_BYTES
    middle[dealt] = three + MARK_BYTES
    cut, end = begin + head, starts[1:] - tail
    data = np.empty(starts[-1], dtype=np.uint8)
    for place, moved in displacements(_pieces(begin, cut, end), _pieces(prefix - begin, middle - cut, suffix - end), len(data)):
        data[place] = out[place + moved]
    return data, starts


def _characters(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    first = (data & 0xC0) != 0x80
    return np.array([np.count_nonzero(first[a:b]) for a, b in zip(begin, stop)], dtype=np.int64)


# -- Spark ------------------------------------------------------------------------------

def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, places = flat(part.column(1))
            drawn = [np.asarray(part.column(2 + k)) for k in range(4)]
            for lo, hi in groups(places):
                own, starts = data[places[lo]:places[hi]], places[lo:hi + 1] - places[lo]
                h1, h2, h3, h4 = (h[lo:hi] for h in drawn)
                ends = unit_ends(own, starts)
                known = np.searchsorted(ends, starts, "right")
                n = np.diff(known)
                a, b = h1 % (n + 1), h2 % (n + 1)
                edge = np.concatenate([[0], ends])
                at = lambda k: np.where(k == 0, starts[:-1], edge[known[:-1] + k])  # noqa: E731, B023
                cut, end = at(np.minimum(a, b)), at(np.maximum(a, b))
                form = np.where(h4 % 100 < spm_rate, SPM, PSM)
                form[(np.diff(starts) == 0) | (h3 % 100 >= rate)] = PLAIN
                form[find_marks(own, starts)[1]] = PLAIN
                plain = form == PLAIN
                counts = [pa.array(_characters(own, x, y), mask=plain) for x, y in ((starts[:-1], cut), (cut, end))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(np.array(FORMS)[form]), *counts,
                     as_text(*scatter(own, starts, cut, end, form))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col(id_col), seed))]).mapInArrow(batches, TRANSFORMED)


def restore(transformed: DataFrame) -> DataFrame:
    """Rows of `transform` with the text rebuilt from output and form: `restored`."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, places = flat(part.column(part.schema.get_field_index("output")))
            form = pc.index_in(part.column(part.schema.get_field_index("form")), pa.array(FORMS)).to_numpy(zero_copy_only=False)
            for lo, hi in groups(places):
                own, starts = data[places[lo]:places[hi]], places[lo:hi + 1] - places[lo]
                text = as_text(*gather(own, starts, form[lo:hi]))
                yield pa.RecordBatch.from_arrays([*part.slice(lo, hi - lo).columns, text], [*part.schema.names, "restored"])

    return transformed.mapInArrow(batches, f"{TRANSFORMED}, restored string")
