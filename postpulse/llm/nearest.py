"""Nearest neighbours by inner product: a block matrix join in 8 bits, exact in the end.

Queries and candidates are packed into blocks. A tile is the product of two blocks of 8-bit
vectors; the rounding error of each vector bounds how far a product may be off. Pairs whose upper
bound reaches a query's k-th best lower bound survive and are computed again from the original
vectors in double precision. Heaps merge the best of all tiles of a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .rows import reach_workers, stored

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 16_384
#: Queries of a block that are multiplied at a time.
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 18


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, times) of rows that take part; rows alike in both are one with their number.

    Left out: null ids and vectors, vectors with a null or non-finite component, zero vectors.
    """
    finite = F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(
        finite & F.exists(vector_col, lambda x: x != 0)
    )
    return rows.groupBy(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).agg(F.count("*").alias("times"))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit components, scale, norm of the rounded vector, norm of what rounding took away."""
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = 1.0
    small = np.rint(vectors / scale[:, None]).astype(np.int8)
    rounded = small * scale[:, None]
    lost = np.linalg.norm(vectors - rounded, axis=1)
    return small, scale, np.linalg.norm(rounded, axis=1), lost


def survivors(query_block, candidate_block, own: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, candidate) places whose product may be among the k largest of their query.

    The product of rounded vectors is off by at most |rounded q||lost c| + |lost q||c|. ``own``
    marks pairs that are one row. Products of up to 1000 8-bit components are exact in 32 bits.
    """
    q, q_scale, q_norm, q_lost = query_block
    c, c_scale, c_norm, c_lost = candidate_block
    left = q.astype(np.float32 if q.shape[1] <= 1000 else np.float64)
    right = c.astype(left.dtype).T
    products = (left @ right).astype(np.float64) * q_scale[:, None] * c_scale
    error = q_norm[:, None] * c_lost + q_lost[:, None] * (c_norm + c_lost)
    # What double precision itself may add.
    error += 1e-12 * (q_norm + q_lost)[:, None] * (c_norm + c_lost)
    low = np.where(own, -np.inf, products - error)
    if low.shape[1] > k:
        bar = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        bar = np.full(len(low), -np.inf)
    return np.nonzero((products + error >= bar[:, None]) & ~own)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component on."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def best(scores: np.ndarray, ids: np.ndarray, times: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """The k largest scores, ties to smaller ids, as (-score, id, times)."""
    return heapq.nsmallest(k, zip((-scores).tolist(), ids.tolist(), times.tolist(), strict=True))


def copies(q: pd.DataFrame, c: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are the query's own row and no other, and how often the candidate counts for
    the query: a row that has equal ones has one other less."""
    own = q["id"].to_numpy()[:, None] == c["id"].to_numpy()
    times = np.broadcast_to(c["times"].to_numpy(), own.shape)
    if own.any():
        times = times.copy()
        for i, j in zip(*np.nonzero(own), strict=True):
            equal = np.array_equal(q["vector"].iloc[i], c["vector"].iloc[j])
            own[i, j] = equal and times[i, j] == 1
            times[i, j] -= equal
    return own, times


_TILE_COLUMNS = {
    "key": "bigint", "query": "bigint", "again": "bigint", "vec_id": "bigint", "score": "double",
    "times": "bigint",
}


def _tile(k: int):
    def tile(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        # Vectors of other lengths than a query's have no product with it.
        q_sizes, c_sizes = queries["vector"].map(len), candidates["vector"].map(len)
        for size in set(q_sizes).intersection(c_sizes):
            some_q, some_c = queries[q_sizes == size], candidates[c_sizes == size]
            keys, again = some_q["key"].to_numpy(), some_q["times"].to_numpy()
            c_ids = some_c["id"].to_numpy()
            q, c = np.stack(some_q["vector"].tolist()), np.stack(some_c["vector"].tolist())
            q_small, c_small = quantised(q), quantised(c)
            for at in range(0, len(q), ROWS_AT_ONCE):
                rows = slice(at, at + ROWS_AT_ONCE)
                own, times = copies(some_q.iloc[rows], some_c)
                i, j = survivors([x[rows] for x in q_small], c_small, own, k)
                scores = np.concatenate(
                    [np.empty(0)]
                    + [
                        exact_products(q[at + i[p : p + PAIRS_AT_ONCE]], c[j[p : p + PAIRS_AT_ONCE]])
                        for p in range(0, len(i), PAIRS_AT_ONCE)
                    ]
                )
                ends = np.searchsorted(i, np.arange(len(own) + 1))
                for n, (first, last) in enumerate(zip(ends, ends[1:], strict=False)):
                    others = j[first:last]
                    found = best(scores[first:last], c_ids[others], times[n, others], k)
                    query = (keys[at + n], some_q["id"].iloc[at + n], again[at + n])
                    out += [(*query, other, -s, m) for s, other, m in found]
        return pd.DataFrame(out, columns=list(_TILE_COLUMNS))

    return tile


def _merge(k: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, found in rows.groupby("key", sort=False):
            query, again = found["query"].iloc[0], found["again"].iloc[0]
            entries = best(*(found[c].to_numpy() for c in ("score", "vec_id", "times")), k)
            each = [(other, -s) for s, other, m in entries for _ in range(min(m, k))][:k]
            ranked = [(query, rank, *e) for rank, e in enumerate(each, 1)]
            out += ranked * int(again)
        return pd.DataFrame(out, columns=["query", "rank", "vec_id", "score"])

    return merge


def _blocks(rows: DataFrame, size: int) -> tuple[Column, int]:
    """A block number by hash, for blocks of about ``size`` rows."""
    count = max(1, -(-rows.count() // size))
    return F.pmod(F.xxhash64("id", "vector"), F.lit(count)).cast("int"), count


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query, rank, vec_id, score): for each query its k nearest rows but its own.

    Rows that share an id are rows of their own, as queries and as candidates; a query's own row is
    one that equals it in id and vector. Fewer candidates give fewer rows; a query without any
    gives none. Vectors of different lengths have no product. Other columns are not used.
    """
    reach_workers(candidates.sparkSession)
    asked = usable(queries, id_col, vector_col)
    q = stored(asked.withColumn("key", F.monotonically_increasing_id()), "queries")
    c = stored(usable(candidates, id_col, vector_col), "candidates")
    q_block, q_count = _blocks(q, query_block)
    c_block, c_count = _blocks(c, candidate_block)
    # Each block meets each block of the other side once: the stated queries against all rows.
    every_c = F.explode(F.sequence(F.lit(0), F.lit(c_count - 1)))
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_count - 1)))
    left = q.select("key", "id", "vector", "times", q_block.alias("qb")).withColumn("cb", every_c)
    right = c.select("id", "vector", "times", c_block.alias("cb")).withColumn("qb", every_q)
    tiles = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(_tile(k), ", ".join(f"{c} {t}" for c, t in _TILE_COLUMNS.items()))
    )
    parts = F.lit(max(1, 8 * q_count))
    return (
        tiles.withColumn("part", F.pmod(F.xxhash64("key"), parts))
        .groupBy("part")
        .applyInPandas(_merge(k), "query bigint, rank int, vec_id bigint, score double")
    )
