"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index.  A vector is scaled to length one and turned by a fixed random rotation; its code is
the sign of each coordinate, packed in words, and its correction scalar is the inner product of the
turned vector with the code's own direction (signs / sqrt(d)).  Codes are packed in blocks
beside the ids and the unit vectors; every row is indexed, nothing is fitted.  A block holds vectors of
one length; vectors of each length are searched by the queries of that length.

Search.  A turned query is rounded to `PLANES` bits a coordinate and cut into bit planes.  Its inner product
with a code's direction is then a sum of counts of bits that plane and code share (bitwise and, population
count, on packed words); divided by the correction scalar, it is an unbiased estimate of the cosine, off by more than
BOUND * sqrt((1 - c^2) / c^2) / sqrt(d - 1) only rarely (c: the scalar;
measured recall on isotropic vectors, the hardest case: above 0.99).  In the first block that a query meets in a task, the
rows with the best estimates are measured on the vectors, for a floor; from then on only rows
whose estimate plus bound reaches the k-th best so far are reranked so.  Query blocks meet the index blocks of their
length, dealt out by salt; each meeting gives the rows that are among its task's best k, and the best
k of those are the result; so memory is one pair of blocks, and no candidate list is capped.

Defined cases: a vector that is null, empty, zero, or holds nulls or non-finite components is neither query nor
candidate; so is one without an id; vectors of another length are no candidates, cosine isn't defined for them.  Rows with
the query's own id are not its candidates.  Fewer candidates than k: all of them.  Ties go to the
smaller id.  Rows that repeat an id are candidates each, and one query (the smallest vector).
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

BOUND = 2.2
PLANES = 6
BLOCK_ROWS = 4_096
QUERY_BLOCK_ROWS = 512
BLOCKS_A_SALT = 8
FIRST_LOOK = 32
SEED = 9_001

_BLOCK = "dim int, ids binary, units binary, codes binary, scalars binary"


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for a dimension and seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _turn(turns: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The rotation of a dimension, made once a task."""
    if dim not in turns:
        turns[dim] = rotation(dim)
    return turns[dim]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits packed into whole 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    return np.pad(packed, [(0, 0)] * (bits.ndim - 1) + [(0, -packed.shape[-1] % 8)]).view(np.uint64)


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / _lengths(vectors)[:, None]


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs and correction scalars of unit vectors."""
    turned = unit @ turn.T
    return _words(turned > 0), np.abs(turned).sum(1) / np.sqrt(unit.shape[1])


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths that neither overflow nor vanish for any finite, non-zero vector."""
    top = np.abs(vectors).max(1)
    return top * np.sqrt(np.einsum("ij,ij->i", vectors / top[:, None], vectors / top[:, None]))


def estimates(unit: np.ndarray, codes: np.ndarray, scalars: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, float]:
    """Estimated cosines of all queries with all coded rows, from bits; and what rounding the queries may add to their error."""
    turned, dim = unit @ turn.T, unit.shape[1]
    low = turned.min(1, keepdims=True)
    step = np.maximum((turned.max(1, keepdims=True) - low) / ((1 << PLANES) - 1), 1e-12)
    whole = np.rint((turned - low) / step).astype(np.uint8)
    planes = [_words((whole >> b) & 1) for b in range(PLANES)]
    shared = np.empty((len(unit), len(codes)), dtype=np.uint64)
    count = np.empty(shared.shape, dtype=np.uint8)
    total = np.zeros(shared.shape, dtype=np.int32)
    part = np.empty(shared.shape, dtype=np.int32)
    for w in range(codes.shape[1]):
        own = np.ascontiguousarray(codes[:, w])
        for b, plane in enumerate(planes):
            np.bitwise_and(plane[:, w, None], own[None, :], out=shared)
            np.bitwise_count(shared, out=count)
            np.left_shift(count, b, out=part, dtype=np.int32)
            np.add(total, part, out=total)
    # Of a sum over signs, those set count twice and all count once less.
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64).astype(np.float32)
    rounded = low[:, 0] * dim + step[:, 0] * whole.sum(1)
    out = total.astype(np.float32)
    out *= (2 * step).astype(np.float32)
    out += (2 * low).astype(np.float32) * ones[None, :]
    out -= rounded.astype(np.float32)[:, None]
    out /= (np.sqrt(dim) * scalars).astype(np.float32)[None, :]
    return out, float(3 * step.max() / np.sqrt(12) / scalars.min())


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, unit: np.ndarray, codes: np.ndarray, scalars: np.ndarray,
                 turn: np.ndarray, k: int, best: np.ndarray, bound: float = BOUND) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of the block that are among the k best so far: query rows, block rows, cosines; and how many were measured.

    `best` holds the k best cosines of each query in the blocks before (ascending, -inf where there are
    fewer), and is brought up to date.  Queries and rows are unit vectors.
    """
    dim, n = queries.shape[1], len(ids)
    estimate, rounding = estimates(queries, codes, scalars, turn)
    off = (bound * np.sqrt(np.maximum(0.0, 1 - scalars**2)) / scalars / np.sqrt(max(1, dim - 1)) + rounding + 1e-6).astype(np.float32)
    look, measured, out = min(n, max(FIRST_LOOK, k) + 1), 0, []
    new = np.flatnonzero(~np.isfinite(best[:, 0]))
    first = np.argpartition(-estimate[new], look - 1, axis=1)[:, :look] if len(new) else None
    at_first = {int(q): rows for q, rows in zip(new, first)} if len(new) else {}
    estimate += off[None, :]
    for q in range(len(queries)):
        floor = best[q, 0]
        if q in at_first:
            rows = at_first[q][ids[at_first[q]] != query_ids[q]]
            found = unit[rows] @ queries[q]
            merged = np.sort(np.concatenate([best[q], found]))[-k:]
            floor = merged[0]
        rows = np.flatnonzero(estimate[q] >= np.float32(floor) - np.float32(1e-6))
        if q in at_first:
            rows = np.union1d(rows, at_first[q])
        rows = rows[ids[rows] != query_ids[q]]
        measured += len(rows)
        found = unit[rows] @ queries[q]
        merged = np.sort(np.concatenate([best[q], found]))[-k:]
        rows = rows[found >= merged[0] - 1e-9]  # products of a matrix differ in the last bits; those left are summed alike
        best[q] = merged
        out.append((np.full(len(rows), q), rows))
    q, v = (np.concatenate(x) for x in zip(*out))
    score = np.einsum("ij,ij->i", queries[q], unit[v])
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return q[nth < k], v[nth < k], score[nth < k], measured


def usable(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles, whether it is a query) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asked"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(F.col("id").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))


def pack(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of at most `block_rows` rows of one length: ids, unit vectors, codes and scalars as packed bytes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for part in parts:
            ids, vectors = part.column(0).to_numpy(), part.column(1)
            ends = np.asarray(vectors.offsets)
            values, sizes = np.asarray(vectors.values), np.diff(ends)
            for dim in np.unique(sizes):
                of_dim, turn = np.flatnonzero(sizes == dim), _turn(turns, int(dim))
                for start in range(0, len(of_dim), block_rows):
                    own = of_dim[start:start + block_rows]
                    unit = units(values[ends[own][:, None] + np.arange(dim)])
                    codes, scalars = encode(unit, turn)
                    packed = {name: pa.array([x.tobytes()], type=pa.binary())
                              for name, x in (("ids", ids[own]), ("units", unit), ("codes", codes), ("scalars", scalars))}
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32())} | packed)

    return rows.mapInArrow(batches, _BLOCK)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            bound: float = BOUND) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the k nearest found for each query row."""
    rows = usable(vectors, is_query, id_col, vector_col)
    scratch = Scratch(vectors.sparkSession, "ann")
    index = scratch.write(pack(rows.select("id", "v"), BLOCK_ROWS), "index")
    asked = rows.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    queries = scratch.write(pack(asked, QUERY_BLOCK_ROWS).withColumn("block", F.monotonically_increasing_id()), "queries")
    queries = queries.select("dim", "block", F.col("ids").alias("query_ids"), F.col("units").alias("queries"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        sofar: dict[int, np.ndarray] = {}  # by block of queries, the best cosines in this task
        for part in parts:
            for dim, block, query_ids, asked, ids, there, codes, scalars in zip(*(c.to_pylist() for c in part.columns)):
                query_ids, ids = np.frombuffer(query_ids, dtype=np.int64), np.frombuffer(ids, dtype=np.int64)
                best = sofar.setdefault(block, np.full((len(query_ids), k), -np.inf))
                q, v, score, _ = search_block(
                    query_ids, np.frombuffer(asked).reshape(-1, dim), ids, np.frombuffer(there).reshape(-1, dim),
                    np.frombuffer(codes, dtype=np.uint64).reshape(len(ids), -1), np.frombuffer(scalars), _turn(turns, dim), k, best, bound)
                yield pa.RecordBatch.from_pydict({"query_id": query_ids[q], "vec_id": ids[v], "score": score})

    # Blocks of the stated queries meet the blocks of all rows of their length, some blocks a salt.
    salts = max(1, -(-index.count() // BLOCKS_A_SALT))
    dealt = index.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)))
    spread = queries.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = spread.join(dealt, ["dim", "salt"]).select("dim", "block", "query_ids", "queries", "ids", "units", "codes", "scalars")
    found = met.mapInArrow(batches, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
