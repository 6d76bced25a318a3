"""Vector codes by product quantization, its codebooks trained by Lloyd rounds over cover trees.

Vectors are rounded down to integers and cut into equal parts. The rows of a partition are indexed in blocks: per part a cover
tree, whose nodes hold a centre, a radius and a range of the tree's order; running sums over that order give the sum of
any subtree at once. A Lloyd round asks, level by level, which entries can be nearest to some point of a node: by the
triangle inequality those not farther from its centre than the nearest by twice the radius. Where one is left the whole
subtree is assigned to it; only ambiguous nodes descend, at last to exact comparisons of their points with the entries left.
All distances are whole numbers, so the result is that of comparing every vector with every entry.

Trees are built once, each by the task that reads its rows, and written. A round sends only per-entry sums on, at most one
set per task.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.common import by_batch, returning_memory
from kinweave.session import cut, discarded, ship_package

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows of a block, and points of a node that is not divided any more.
BLOCK_ROWS, LEAF = 2_048, 8
FAR = np.iinfo(np.int64).max


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry, in whole numbers."""
    norm = lambda a: np.einsum("ij,ij->i", a, a)
    return norm(points)[:, None] - 2 * (points @ entries.T) + norm(entries)[None, :]


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """The cover tree of a block: points in tree order, and its nodes level by level.

    A node of radius r is divided around centres more than r / 2 apart, its own centre the first, found by going to the
    farthest point again and again until every point is within r / 2 of one; each point goes to its nearest.
    """
    n = len(points)
    order, nodes = np.arange(n), []

    def node(lo: int, hi: int, centre: int, parent: int) -> list[int]:
        far = points[order[lo:hi]] - points[centre]
        return [lo, hi, centre, int(np.einsum("ij,ij->i", far, far).max()), parent]

    level, first = ([node(0, n, 0, -1)] if n else []), 0
    ends = [0]
    while level:
        nodes += level
        ends.append(len(nodes))
        below = []
        for k, (lo, hi, centre, radius, _) in enumerate(level):
            if hi - lo <= LEAF or radius == 0:
                continue
            own, here = order[lo:hi], points[order[lo:hi]]
            centres, nearest = [centre], np.zeros(hi - lo, np.int64)
            apart = here - points[centre]
            least = np.einsum("ij,ij->i", apart, apart)
            while (at := int(least.argmax())) is not None and 4 * least[at] > radius:
                apart = here - here[at]
                there = np.einsum("ij,ij->i", apart, apart)
                nearest[there < least] = len(centres)
                np.minimum(least, there, out=least)
                centres.append(own[at])
            place = np.argsort(nearest, kind="stable")
            order[lo:hi] = own[place]
            cuts = lo + np.searchsorted(nearest[place], np.arange(len(centres) + 1))
            below += [node(a, b, c, first + k) for a, b, c in zip(cuts[:-1], cuts[1:], centres)]
        first, level = first + len(level), below
    lo, hi, centre, radius, parent = np.array(nodes, np.int64).reshape(-1, 5).T
    return {
        "order": order, "points": points[order], "centres": points[centre], "lo": lo, "hi": hi,
        "radius": np.sqrt(radius.astype(np.float64)), "parent": parent, "ends": np.array(ends),
    }


def assign(tree: dict[str, np.ndarray], entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(lo, hi, entry)`` ranges of the tree's order, each of whole subtrees or single points, with their nearest entry.

    Ties go to the lower entry.
    """
    ends = tree["ends"]
    open_ = np.zeros((len(tree["lo"]), len(entries)), bool)  # entries that an ambiguous node leaves to its children
    descends = np.zeros(len(tree["lo"]), bool)
    inner = np.zeros(len(tree["lo"]), bool)
    inner[tree["parent"][tree["parent"] >= 0]] = True
    for start, end in zip(ends[:-1], ends[1:]):
        here = np.arange(start, end)
        if start:
            here = here[descends[tree["parent"][here]]]
        if not len(here):
            return
        left = open_[tree["parent"][here]] if start else np.ones((len(here), len(entries)), bool)
        far = np.where(left, squares(tree["centres"][here], entries), FAR)
        best = far.argmin(axis=1)
        reach = np.sqrt(far[np.arange(len(here)), best].astype(np.float64)) + 2 * tree["radius"][here]
        left &= np.sqrt(far.astype(np.float64)) <= (reach * (1 + 1e-9) + 1e-6)[:, None]
        settled = (left.sum(axis=1) == 1) | (tree["radius"][here] == 0)
        yield tree["lo"][here[settled]], tree["hi"][here[settled]], best[settled]
        further = ~settled & inner[here]
        descends[here[further]], open_[here[further]] = True, left[further]
        leaves = ~settled & ~inner[here]
        if leaves.any():
            sizes = (tree["hi"] - tree["lo"])[here[leaves]]
            single = np.concatenate([np.arange(a, b) for a, b in zip(tree["lo"][here[leaves]], tree["hi"][here[leaves]])])
            exact = np.where(np.repeat(left[leaves], sizes, axis=0), squares(tree["points"][single], entries), FAR)
            yield single, single + 1, exact.argmin(axis=1)


def labels(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point of the block, in the rows' own order, and the squared distance to it."""
    found = np.empty(len(tree["order"]), np.int64)
    for lo, hi, entry in assign(tree, entries):
        for a, b, e in zip(lo, hi, entry):
            found[a:b] = e
    apart = tree["points"] - entries[found]
    back = np.empty_like(tree["order"])
    back[tree["order"]] = np.arange(len(back))
    return found[back], np.einsum("ij,ij->i", apart, apart)[back]


def _packed(tree: dict[str, np.ndarray]) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **tree)
    return buffer.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


def forest(kept: DataFrame, parts: int, dims: int) -> DataFrame:
    """``(docs, trees)``: a row per block of ``(doc, v)`` rows, with a packed tree per part."""
    each = dims // parts

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for start in range(0, rows.num_rows, BLOCK_ROWS):
                some = rows.slice(start, BLOCK_ROWS)
                n = some.num_rows
                points = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
                trees = [_packed(build(np.ascontiguousarray(points[:, p * each : (p + 1) * each]))) for p in range(parts)]
                docs = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), some.column("doc"))
                yield pa.RecordBatch.from_arrays([docs, pa.array([trees], pa.list_(pa.binary()))], names=["docs", "trees"])

        return batch

    return by_batch(kept, make, f"docs array<{kept.schema['doc'].dataType.simpleString()}>, trees array<binary>")


def sums(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``(part, entry, at, n, total)``: how many parts are nearest to an entry, and the sum of their component ``at``."""
    parts, entries, each = books.shape
    ship_package(trees.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, each), np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for p, packed in enumerate(row.values.to_pylist()):
                    tree = _unpacked(packed)
                    running = np.zeros((len(tree["points"]) + 1, each), np.int64)
                    np.cumsum(tree["points"], axis=0, out=running[1:])
                    for lo, hi, entry in assign(tree, books[p]):
                        np.add.at(n[p], entry, hi - lo)
                        np.add.at(total[p], entry, running[hi] - running[lo])
        part, entry = np.nonzero(n)
        columns = [np.repeat(part, each), np.repeat(entry, each), np.tile(np.arange(each), len(part))]
        columns = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(np.repeat(n[part, entry], each)), pa.array(total[part, entry].ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "at", "n", "total"])

    met = trees.select("trees").mapInArrow(returning_memory(run), "part int, entry int, at int, n long, total long")
    return met.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def coded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``(doc, codes, error)``: the nearest entry of every part, and the squared distances summed over the parts."""

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for docs, packed in zip(rows.column("docs"), rows.column("trees")):
                found = [labels(_unpacked(data), book) for data, book in zip(packed.values.to_pylist(), books)]
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.int32)
                ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
                columns = [docs.values, pa.ListArray.from_arrays(ends, pa.array(codes.ravel())), pa.array(sum(e for _, e in found))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "codes", "error"])

        return batch

    return by_batch(trees, make, f"doc {trees.schema['docs'].dataType.elementType.simpleString()}, codes array<int>, error long")


def compress(
    vectors: DataFrame, carry: Sequence[str], id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``(doc, codes, error)`` of every vector, and the codebooks by part, entry and position.

    ``doc`` holds the columns named in ``carry``. Vectors that are null or hold a null or non-finite component take no part.
    Codebooks start from the vectors of the ``entries`` smallest ids, null ids last; equal ids are told apart by their
    vectors. With fewer vectors there are as many entries. An entry that no vector is nearest to stays as it is. Vectors must
    be of one length that ``parts`` divides, with components whose squared distances fit 64 bits; otherwise a ValueError says so.
    """
    spark = vectors.sparkSession
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(F.struct(*carry).alias("doc"), F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where(F.col("x").isNotNull() & F.forall("x", finite))
    largest = F.max(F.coalesce(F.array_max(F.transform("x", F.abs)), F.lit(0.0)))
    low, high, most = rows.agg(F.min(F.size("x")), F.max(F.size("x")), largest).first()
    dims = high or 0
    if low != high or dims % parts:
        raise ValueError(f"vectors of {low} to {high} components cannot be cut into {parts} equal parts")
    if 4 * max(dims, 1) * ((most or 0.0) * scale + 1) ** 2 >= 2.0**62:
        raise ValueError(f"components up to {most} are too large for whole squared distances")
    kept = rows.select("doc", "id", F.transform("x", lambda x: F.floor(x * float(scale)).cast("long")).alias("v"))
    first = kept.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    with discarded(spark):
        trees = cut(forest(kept.select("doc", "v"), parts, dims), "cover-trees")
        for _ in range(rounds):
            for r in sums(trees, books).collect():  # a row per component of the codebooks
                books[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
        return cut(coded(trees, books), "vector-codes", outlives=True), books


def per_vector(vectors: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``; null labels are one label."""
    found, books = compress(vectors, ["vec_id", "label"])
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    per_label = cut(found.groupBy(F.col("doc.label").alias("label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return found.join(per_label, F.col("doc.label").eqNullSafe(F.col("label"))).select(
        F.col("doc.vec_id").alias("vec_id"), F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error", "label_error", F.lit(digest).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    nearest = """
a{k} AS MATERIALIZED (
    SELECT r, p, arg_min(e, (dist, e)) AS e, min(dist) AS dist FROM (
        SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
        FROM x JOIN b{k} b USING (p))
    GROUP BY r, p),"""
    update = """
m{k} AS MATERIALIZED (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
        SELECT p, e, i, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS m
        FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM a{j} JOIN x USING (r, p)) GROUP BY p, e, i)
    GROUP BY p, e),
b{k} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM b{j} b LEFT JOIN m{k} m USING (p, e)),"""
    steps = "".join(nearest.format(k=k) + update.format(j=k, k=k + 1) for k in range(ROUNDS)) + nearest.format(k=ROUNDS)
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda y: CAST(floor({SCALE} * CAST(y AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
    SELECT r, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS v FROM kept, (SELECT unnest(range({PARTS})) AS p)),
b0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY r) - 1 AS e, v FROM x WHERE r <= {ENTRIES}),{steps}
books AS (SELECT sha256(string_agg(c, ',' ORDER BY p, e)) AS codebooks_sha256
          FROM (SELECT p, e, array_to_string(v, ',') AS c FROM b{ROUNDS})),
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), books
"""


ORACLE = _oracle()
