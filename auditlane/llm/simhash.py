"""SimHash near-dedup with bit-sliced comparison.

Fingerprint.  A-Z are lower-cased and the whole text is cut into words and shingles of
`shingle_words` words (fewer words: all of them); a bit is 1 if it is set in more than half
of the shingles' hashes (XXH64, seed 42).  Python computes them in Arrow batches, without a shuffle.

Candidates.  Equal fingerprints are combined first.  The 64 bits are cut into m stripes; two
fingerprints within the radius r agree in at least m - r stripes, so for each choice of m - r
stripes the fingerprints are grouped by those bits, and no link can be missed.  m grows with the
number of fingerprints so that a group holds about one block; every m gives the same links.  Groups
above a block (fingerprints that crowd) are counted first and cut once more, by the same rule: the bits that
they don't share are cut into r + 2 stripes, of which two within the radius agree in two at least.

Comparison.  A group that is still larger is dealt into blocks of about equal size by a hash, so that no task holds
a group; each block meets itself and, spread by salt, the group's other blocks.  A block is stored vertically: plane p holds bit p of 64 fingerprints in a 64-bit
word.  XOR with a query bit gives 64 differences at once, carry-save adders count them in bit counters
(ones, twos, fours, and an overflow that stays), and after every eight planes the words in which
each lane has passed the radius are abandoned.  A block reports a spanning forest of its links, so
a dense group costs as many rows as it has fingerprints.

Components.  Links are contracted round by round: each fingerprint joins the neighbour (or
itself) with the smallest hash of the round.  All of it stays in written tables; the number
of rounds grows with the logarithm of the longest chain.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; very long texts are read whole, one
at a time (some 40 bytes beside them for each word); rows that
repeat a doc_id are rows each; a null doc_id is never the smallest unless a component has no
other; an empty table gives an empty result; extra columns are ignored (`drop_near_copies` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch, with_keys

SHINGLE_WORDS = 4
RADIUS = 4
HASH_SEED = 42
BITS = 64
BLOCK = 1_024
GROUP = 64
SPREAD = 64
CHUNK = 1 << 14
PART = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII space parts
    if not words:
        return 0
    take = min(shingle_words, len(words))
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends.tolist()
    digest = xxhash.xxh64_intdigest
    count, total = np.zeros(BITS, dtype=np.int64), len(words) - take + 1
    for first in range(0, total, PART):
        last = min(total, first + PART)
        spans = zip(starts[first:last], ends[first + take - 1:last + take - 1])
        hashes = np.fromiter((digest(body[a:b], HASH_SEED) for a, b in spans), dtype="<u8", count=last - first)
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(words, 64) lanes of fingerprints -> (64, words): word w of plane p holds bit p of the 64 lanes."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(len(prints), BITS, 8), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: the sum's low and high bits, for 64 lanes a word."""
    either = a ^ b
    return either ^ c, (a & b) | (either & c)


def _past(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose count is above the radius."""
    past, level = over.copy(), ~over
    for bit, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            level = level & plane
        else:
            past, level = past | (level & plane), level & ~plane
    return past


def compare(queries: np.ndarray, words: np.ndarray, planes: np.ndarray, alive: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within the radius: (rows, lanes), where row k compares queries[k] with word words[k].

    `alive` masks the lanes of each row that count.
    """
    rows = np.arange(len(queries))
    zero = np.zeros(len(queries), dtype=np.uint64)
    ones, twos, fours, over = zero, zero, zero, zero
    for base in range(0, BITS, 8):
        d = [planes[p][words] ^ (np.uint64(0) - ((queries >> np.uint64(p)) & np.uint64(1))) for p in range(base, base + 8)]
        ones, a = _add(ones, d[0], d[1])
        ones, b = _add(ones, d[2], d[3])
        twos, c = _add(twos, a, b)
        ones, a = _add(ones, d[4], d[5])
        ones, b = _add(ones, d[6], d[7])
        twos, e = _add(twos, a, b)
        fours, eights = _add(fours, c, e)
        over = over | eights
        alive = alive & ~_past(ones, twos, fours, over, radius)
        some = np.flatnonzero(alive)
        if len(some) < len(alive):  # abandoned: every lane has passed the radius
            rows, queries, words, alive = rows[some], queries[some], words[some], alive[some]
            ones, twos, fours, over = ones[some], twos[some], fours[some], over[some]
        if not len(rows):
            break
    hit, lane = np.nonzero(np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return rows[hit], lane


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest index of each component) after linking a[k] and b[k]."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def links_in(lefts: list[np.ndarray], rights: list[np.ndarray | None], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between each left block and its right block (None: itself)."""
    items, query, word, mask, lanes, home = [], [], [], [], [], []
    n_items = n_words = 0
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for left, right in zip(lefts, rights):
        first = n_items
        items.append(left)
        n_items += len(left)
        side, start = (left, first) if right is None else (right, n_items)
        if right is not None:
            items.append(right)
            n_items += len(right)
        wide = -(-len(side) // BITS)
        padded = np.zeros(wide * BITS, dtype=np.uint64)
        padded[:len(side)] = side
        lanes.append(padded.reshape(wide, BITS))
        home.append(start + BITS * np.arange(wide))
        used = np.full(wide, full)
        if len(side) % BITS:
            used[-1] = full >> np.uint64(BITS - len(side) % BITS)
        q = np.arange(len(left))
        own = q // BITS if right is None else np.zeros(len(left), dtype=np.int64)
        per = wide - own
        qs = np.repeat(q, per)
        ws = np.arange(len(qs)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(own, per)
        m = used[ws]
        if right is None:  # of its own word, a lane meets those after it
            same = ws == qs // BITS
            m = np.where(same, m & ~((np.uint64(2) << (qs % BITS).astype(np.uint64)) - np.uint64(1)), m)
        query.append(first + qs)
        word.append(n_words + ws)
        mask.append(m)
        n_words += wide
    prints, at = np.concatenate(items), np.concatenate(query)
    word, mask, home = np.concatenate(word), np.concatenate(mask), np.concatenate(home)
    planes = planes_of(np.concatenate(lanes))
    label = np.arange(len(prints))
    for start in range(0, len(at), CHUNK):
        part = slice(start, start + CHUNK)
        rows, lane = compare(prints[at[part]], word[part], planes, mask[part], radius)
        label = _merge(label, at[part][rows], home[word[part][rows]] + lane)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return prints[moved], prints[label[moved]]


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, print (the fingerprint as a signed long)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = np.array([fingerprint(t, shingle_words) for t in part.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "text_key": part.column(1), "print": pa.array(prints.view(np.int64))})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).mapInArrow(
        batches, "doc_id long, text_key long, print long")


def stripe_masks(n: int, radius: int) -> list[int]:
    """Masks of the bits to group by, so that a group of n random fingerprints holds about `GROUP`."""
    m = radius + 1
    while m < 16 and n / 2 ** (BITS * (m - radius) // m) > GROUP:
        m += 1
    edges = [BITS * k // m for k in range(m + 1)]
    stripes = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(m)]
    return [sum(stripes[k] for k in chosen) for chosen in combinations(range(m), m - radius)]


def further_masks(mask: int, radius: int) -> list[int]:
    """Masks that add two of radius + 2 stripes of the bits `mask` leaves out: two fingerprints that agree under `mask` and are
    within the radius agree under one of them."""
    free, m = [b for b in range(BITS) if not mask >> b & 1], radius + 2
    stripes = [sum(1 << b for b in free[len(free) * k // m:len(free) * (k + 1) // m]) for k in range(m)]
    return [mask | a | b for a, b in combinations(stripes, 2)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _above_a_block(scratch: Scratch, keyed: DataFrame, name: str) -> DataFrame:
    """(table, key, blocks): the groups of more than one block, and how many blocks they take."""
    counted = keyed.groupBy("table", "key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).where("blocks > 1")
    return scratch.write(counted, name)


def candidates(scratch: Scratch, prints: DataFrame, radius: int) -> DataFrame:
    """Blocks that may hold links: table, key (together a group), blocks (of the group), block, prints."""
    group = ["table", "key"]
    first = stripe_masks(prints.count(), radius)
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in first])
    keyed = prints.select("print", F.posexplode(masks).alias("table", "mask")).select(
        "print", "table", F.col("print").bitwiseAND(F.col("mask")).alias("key"))
    crowded = _above_a_block(scratch, keyed, "crowded")
    if crowded.isEmpty():
        placed = keyed.withColumn("blocks", F.lit(1).cast("long"))
    else:
        # One row a table and further mask: a table of fixed size.
        steps = [(t, m) for t, mask in enumerate(first) for m in further_masks(mask, radius)]
        further = scratch.spark.createDataFrame([(t, len(first) + k, _signed(m)) for k, (t, m) in enumerate(steps)], "table int, next int, mask long")
        cut = (
            keyed.join(crowded, group, "left_semi").join(further, "table")
            .select("print", F.col("next").alias("table"), F.col("print").bitwiseAND(F.col("mask")).alias("key"))
        )
        large = _above_a_block(scratch, cut, "large")
        placed = (
            keyed.join(crowded, group, "left_anti").unionByName(cut)
            .join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        )
    block = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    blocks = placed.groupBy(*group, "blocks", block.alias("block")).agg(F.collect_list("print").alias("prints"))
    return scratch.write(blocks.where((F.size("prints") > 1) | (F.col("blocks") > 1)), "blocks")


def links(scratch: Scratch, prints: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough to connect all that are within the radius."""
    blocks = candidates(scratch, prints, radius)
    # Groups of several blocks: each pair of blocks once, a group's pairs in up to SPREAD places.
    several = blocks.where("blocks > 1")
    salts = F.least(F.col("blocks"), F.lit(SPREAD)).cast("int")
    left = several.select("table", "key", (F.col("block") % salts).alias("salt"), "block", F.col("prints").alias("left"))
    right = several.select("table", "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("block").alias("later"), F.col("prints").alias("right"))
    crossed = left.join(right, ["table", "key", "salt"]).where("block < later").select("left", "right")
    pairs = blocks.select(F.col("prints").alias("left"), F.lit(None).cast("array<bigint>").alias("right")).unionByName(crossed)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = lambda column, k: column[k].values.to_numpy().view(np.uint64)
        for part in parts:
            for start in range(0, part.num_rows, 512):
                some = part.slice(start, 512)
                left, right = some.column(0), some.column(1)
                a, b = links_in([view(left, k) for k in range(some.num_rows)],
                                [view(right, k) if right[k].is_valid else None for k in range(some.num_rows)], radius)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return pairs.mapInArrow(batches, "a long, b long").distinct()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root): the component of every node that has an edge."""
    label, turn = None, 0
    while True:
        edges = scratch.write(edges, f"edges{turn}")
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: E731,B023
        best = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
        step = scratch.write(best.select("a", F.least(rank("a"), F.col("near"))["v"].alias("to")), f"step{turn}")
        moved = (
            edges.join(step.withColumnRenamed("to", "x"), "a")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        )
        edges = moved.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if label is None:
            label = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            onward = step.select(F.col("a").alias("root"), "to")
            label = scratch.write(label.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"label{turn}")
        turn += 1
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, print (signed), root, component_id (the smallest doc_id reachable)."""
    if not 0 <= radius <= 6:
        raise ValueError("the bit counters hold radii from 0 to 6")
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, shingle_words, id_col, text_col), "prints")
    nodes = scratch.write(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(scratch, links(scratch, nodes.select("print"), radius))
    placed = nodes.join(roots, nodes["print"] == roots["node"], "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    first = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = scratch.write(placed.join(first, "root").select("print", "root", "component_id"), "groups")
    return rows.join(groups, "print").select("doc_id", "text_key", "print", "root", "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Of each component the document with the smallest doc_id (nulls last, then by text), with all its columns."""
    groups = near_groups(docs, shingle_words, radius, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = groups.groupBy("root").agg(F.min(place).alias("first"))
    first, keys = with_keys(first, id=F.col("first.doc_id"), text=F.col("first.text_key"))
    keyed, _ = with_keys(docs, id=F.col(id_col).cast("long"), text=F.xxhash64(text_col))
    # Rows that repeat a doc_id and text pass the join together; one of them stays.
    return keyed.join(first.select(*keys), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
