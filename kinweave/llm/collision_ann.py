"""Approximate nearest neighbours by counting collisions in single projections.

A block of vectors is indexed by ``PROJECTIONS`` sorted arrays, one per random direction. A query lays a window
around its own projection in each array; the windows of all arrays widen together, level by level, so the hash
buckets are centred on the query and rehashed virtually. A vector collides once per window it is in; vectors
in ``COLLISIONS`` of the windows or more are candidates, and once a block has given enough of them they are verified
on the original vectors. Largest inner products become smallest distances by one extra coordinate that brings all
vectors of a block to the same length. The vectors of a block are of similar length, so that none squeezes the others
together; lengths that few vectors have share a block in which all are verified.

Queries, a stated set, meet the vectors in blocks; a task holds one block of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kinweave.session import cut, ship_package

PROJECTIONS, SEED = 64, 20
#: Share of the projections a candidate collides in.
COLLISIONS = 0.65
#: Candidates to verify in a block: this share of it and so many times the neighbours sought.
VERIFIED, TIMES = 0.05, 20
#: Half width of the first windows, as the share of the block that the middle window holds, and its growth.
FIRST, GROWTH = 0.38, 1.07
#: Steps of a sorted array at which a window can begin and end.
STEPS = 256
BLOCK_ROWS, QUERY_ROWS = 8_192, 4_096
#: The longest vector of a range of lengths, against the shortest; lengths beyond so many ranges from 1 share the last.
RATIO, RANGES = 1.1, 8_192


def directions(dims: int, n: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """``n`` random unit vectors as columns, orthogonal in groups of ``dims``."""
    random = np.random.default_rng(seed)
    groups = [np.linalg.qr(random.standard_normal((dims, dims)))[0] for _ in range(math.ceil(n / dims))]
    return np.concatenate(groups, axis=1)[:, :n]


class Index:
    """Sorted projections of one block of vectors.

    Beside each sorted array stand bit sets of the vectors before every ``STEPS``-th part of it, so the vectors in
    a window are the difference of two bit sets. A window ends at the steps next to its exact ends.
    """

    def __init__(self, vectors: np.ndarray):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = norms.max(initial=0.0) or 1.0
        extra = np.sqrt(np.maximum(self.longest**2 - norms**2, 0.0))
        self.ways = directions(vectors.shape[1] + 1)
        projected = (np.column_stack([vectors, extra]) @ self.ways / self.longest).T
        n = len(vectors)
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=1)
        self.steps = np.unique(np.linspace(0, n, STEPS + 1).astype(np.int64))
        self.edges = np.column_stack([self.sorted[:, self.steps[:-1]], np.full(len(order), np.inf)])
        rank = np.empty(order.shape, np.int32)
        np.put_along_axis(rank, order, np.arange(n, dtype=np.int32)[None, :], axis=1)
        self.before = np.stack([np.packbits(row[None, :] < self.steps[:, None], axis=1) for row in rank])
        self.n = n

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Positions of the vectors that collide often enough with a query of unit length."""
        m, n = self.sorted.shape
        enough = math.ceil(VERIFIED * n) + TIMES * k
        if enough >= n:
            return np.arange(n)
        at = np.append(query, 0.0) @ self.ways
        each, least = np.arange(m), math.ceil(COLLISIONS * m)
        # The first width lets the middle array's window hold the given share of the block.
        here, reach = self.steps[(self.edges < at[:, None]).sum(axis=1) - 1], int(FIRST * n / 2)
        ends = np.stack([self.sorted[each, np.clip(here + d, 0, n - 1)] for d in (-reach, reach)])
        width = float(np.median(np.abs(ends - at).max(axis=0))) or 1e-12
        while True:
            a = (self.edges < (at - width)[:, None]).sum(axis=1)
            b = (self.edges <= (at + width)[:, None]).sum(axis=1)
            inside = self.before[each, np.minimum(b, len(self.steps) - 1)] & ~self.before[each, np.maximum(a - 1, 0)]
            hits = np.unpackbits(inside, axis=1, count=n).sum(axis=0, dtype=np.uint8)
            found = np.flatnonzero(hits >= least)
            if len(found) >= enough:
                return found
            width *= GROWTH


def _valid(vectors: str):
    """Whether a vector takes part: not null, not zero, and every component finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.col(vectors).isNotNull() & F.forall(vectors, fine) & F.exists(vectors, lambda x: x != 0)


def _range(vectors: str):
    """The number of the range of lengths that a vector is in; 0 is that around 1."""
    length = F.sqrt(F.aggregate(vectors, F.lit(0.0), lambda a, x: a + x * x))
    number = F.least(F.greatest(F.round(F.ln(length) / math.log(RATIO)), F.lit(-1.0 * RANGES)), F.lit(1.0 * RANGES))
    return F.coalesce(number, F.lit(-1.0 * RANGES)).cast("int")


def layout(rows: dict[int, int], k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """``(first range, first block, blocks)``, the last two by range from the first on, for rows by range.

    Neighbouring ranges share a block while all of its vectors would be verified.
    """
    low, whole = min(rows, default=0), int(TIMES * k / (1 - VERIFIED))
    first, many = (np.zeros(max(rows, default=0) - low + 1, np.int32) for _ in range(2))
    at, together, size = 0, [], 0
    for number in [*sorted(rows), None]:
        if together and (number is None or size + rows[number] > whole):
            first[together], many[together] = at, math.ceil(size / BLOCK_ROWS)
            at, together, size = at + math.ceil(size / BLOCK_ROWS), [], 0
        if number is not None:
            together, size = [*together, number - low], size + rows[number]
    return low, first, many


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest found of each query: ``(query_id, rank, vec_id, score)``, by inner product, ties to the smaller id.

    A query's candidates are all vectors under another id. Null and zero vectors and those with a null or
    non-finite component take no part. Rows with the same id are told apart by their vectors, so a repeated row
    counts once; an id is found once per query id, with the best score of any of its vectors and the query's. All vectors
    must be of one length.
    """
    ship_package(vectors.sparkSession)
    cast = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & _valid("v")
    ).distinct()
    base, asked = cut(cast(vectors), "vectors"), cut(cast(queries), "query-vectors")
    low, first, many = layout({r["range"]: r["count"] for r in base.groupBy(_range("v").alias("range")).count().collect()}, k)
    blocks = max(1, int((first + many).max()))
    groups = max(1, math.ceil(asked.count() / QUERY_ROWS))
    of = lambda n, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), n if isinstance(n, Column) else F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of_range = lambda numbers: F.element_at(F.lit(numbers), _range("v") - low + 1)
    base = base.withColumn("block", of_range(first) + of(of_range(many), 1)).withColumn("part", every(groups))
    asked = asked.withColumn("part", of(groups, 2)).withColumn("block", every(blocks))

    def meet(key: tuple, these: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        asking, near, scores = [], [], []
        if len(these) and len(those):
            ids, data = these["id"].to_numpy(), np.stack(these["v"].to_numpy())
            index = Index(data)
            for query_id, v in zip(those["id"], those["v"]):
                query = np.asarray(v, np.float64)
                found = index.candidates(query / np.sqrt((query * query).sum()), k)
                found = found[ids[found] != query_id]
                score = data[found] @ query
                best = found[order := np.lexsort((ids[found], -score))]
                # The first row of each id is its best.
                first = np.sort(np.unique(ids[best], return_index=True)[1])[:k]
                asking.append(np.full(len(first), query_id))
                near.append(ids[best[first]])
                scores.append(score[order[first]])
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return pd.DataFrame({"query_id": flat(asking, np.int64), "vec_id": flat(near, np.int64), "score": flat(scores, np.float64)})

    met = base.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    met = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def twentieth(vectors: DataFrame) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))
