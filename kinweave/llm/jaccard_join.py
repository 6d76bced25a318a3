"""Similarity self-join of documents on word shingles, by chosen paths.

Every distinct shingle set stands for its copies. A set is embedded as ``TOKENS`` minhash tokens, so two sets share
a token with a probability that is their Jaccard similarity. A run starts all sets at a root; at every node a set
moves on along each of its tokens that a hash of the path and the token samples, on average ``BRANCHING`` that two
sets at the threshold share. A node of few sets is a leaf. A node of many is split again, until it is dense, its sets
being alike on average, or ``DEPTH`` deep. Runs are repeated until two sets at the threshold meet in some leaf with
the target probability. Nodes are rows of a table, a level is a shuffle of (path, set) rows.

A pair that meets in several leaves belongs to the first of them, so leaves are worked off independently: bit
sketches leave out pairs that are far from the threshold, then the sets left in a leaf are compared exactly. A leaf
of very many sets is cut into slices, and each two slices meet in a task; such leaves of different runs that hold
nearly the same sets are merged before. Pairs never become rows: a task returns,
per set, its number of links and the smallest set it is connected to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kinweave.llm.common import WORD, by_batch, returning_memory, shingle_hashes
from kinweave.operators.components import connected_components
from kinweave.session import cut, ship_package

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
TOKENS, BRANCHING, DEPTH = 128, 2.0, 3
#: Sets in a leaf that is not split, and in a slice of a leaf that cannot be.
SMALL, SLICE = 64, 512
#: A node is dense if its sets' estimated mean similarity is at least this share of the threshold.
DENSE = 0.9
#: A pair is compared if its sketches agree in at least as many bits as a pair at the threshold does, less so many
#: standard deviations.
DEVIATIONS = 4.5

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_SKETCH_BITS = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_FACTORS = _mixed(np.arange(1, TOKENS + 1, dtype=_U) * _GOLDEN) | _U(1)
_PLACES = _mixed(np.arange(1, TOKENS + 1, dtype=_U) * _U(0xD1B54A32D192ED03))


def runs_needed(recall: float = RECALL) -> int:
    """Runs after which two sets at the threshold have met with probability ``recall``, however deep their leaf."""
    met = 1.0
    for _ in range(DEPTH):
        met = 1 - math.exp(-BRANCHING * met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``TOKENS`` minhash values of a set of shingle hashes."""
    low = np.full(TOKENS, np.iinfo(np.uint64).max, _U)
    mixed = _mixed(shingles)
    with np.errstate(over="ignore"):
        for i in range(0, len(mixed), 2048):
            part = _mixed_multiply(mixed[i : i + 2048])
            np.minimum(low, part.min(axis=0), out=low)
    return (_mixed(low) >> _U(32)).astype(np.uint32)


def _mixed_multiply(x: np.ndarray) -> np.ndarray:
    return x[:, None] * _FACTORS[None, :]


def children(paths: np.ndarray, tokens: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Where sets go on from nodes: ``(row, path)``. ``tokens`` has a row of minhash values for each path."""
    with np.errstate(over="ignore"):
        on = _mixed(paths[:, None] * _GOLDEN + _mixed(tokens.astype(_U) + _PLACES[None, :]))
    row, place = np.nonzero((on >> _U(11)).astype(np.float64) < BRANCHING / similarity / TOKENS * 2.0**53)
    with np.errstate(over="ignore"):
        return row, _mixed(on[row, place] + _GOLDEN)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One bit of each token, as two 64-bit integers."""
    return np.packbits((tokens & 1).astype(np.uint8)).view("<i8")


def _embedded(docs: DataFrame, similarity: float, seed: int) -> DataFrame:
    """One row per document with its set's hash, size, sketch, tokens and first nodes."""
    roots = _mixed(np.arange(1, runs_needed() + 1, dtype=_U) * _U(0xA0761D6478BD642F) + _U(seed))

    def make():
        def run(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets, sizes, first, sketches, tokens, starts = [], [], [], [], [], []
                for text in part.column(1):
                    shingles = shingle_hashes(text.as_py() or "", SHINGLE)
                    sizes.append(len(shingles))
                    if not len(shingles):
                        sets.append((None, None))
                        sketches.append((None, None))
                        tokens.append(None)
                        starts.append([])
                        continue
                    whole = np.frombuffer(xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes(), seed=seed), "<i8")
                    sets.append(tuple(whole.tolist()))
                    values = minhash(shingles)
                    sketches.append(tuple(sketch(values).tolist()))
                    tokens.append(values.astype("<u4").tobytes())
                    starts.append(children(roots, np.broadcast_to(values, (len(roots), TOKENS)), similarity)[1].astype(np.int64))
                column = lambda pairs, k: pa.array([p[k] for p in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), column(sets, 0), column(sets, 1), pa.array(sizes, pa.int64()), column(sketches, 0),
                        column(sketches, 1), pa.array(tokens, pa.binary()), pa.array(starts, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "set", "check", "size", "sketch0", "sketch1", "tokens", "starts"],
                )

        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(
        docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("text")), make,
        f"doc_id {kind}, text_key long, set long, check long, size long, sketch0 long, sketch1 long, tokens binary, starts array<long>",
    )


def _sizes(nodes: DataFrame) -> DataFrame:
    return cut(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "node-sizes")


def _dense(big: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The nodes whose sets agree, on average over all pairs and the bits of a sketch, as dense ones do."""
    bits = [F.sum(F.getbit("sketch0", F.lit(2 * b)).cast("double")).alias(f"b{b}") for b in range(_SKETCH_BITS // 2)]
    ones = big.join(sets.select("set", "sketch0"), "set").groupBy("path").agg(F.count(F.lit(1)).alias("_n"), *bits)
    share = [F.col(f"b{b}") / F.col("_n") for b in range(_SKETCH_BITS // 2)]
    agree = sum((s * s + (1 - s) * (1 - s) for s in share), F.lit(0.0)) / len(share)
    return ones.where(2 * agree - 1 >= DENSE * similarity).select("path", F.lit(True).alias("dense"))


def _leaves(docs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(path, set, n)``: the leaves of all runs that hold two sets or more, with their number of sets."""
    nodes = docs.where(F.col("size") > 0).select(F.explode("starts").alias("path"), "set").distinct()
    found = None
    for depth in range(1, DEPTH + 1):
        nodes = cut(nodes, "nodes")
        nodes = cut(nodes.join(_sizes(nodes), "path"), "shared-nodes")
        big = nodes.where(F.col("n") > SMALL)
        done = depth == DEPTH or big.isEmpty()
        if not done:
            big = cut(big.join(_dense(big, sets, similarity), "path", "left"), "big-nodes")
        leaves = nodes if done else nodes.where(F.col("n") <= SMALL).unionByName(big.where("dense").drop("dense"))
        found = leaves if found is None else found.unionByName(leaves)
        if done:
            break
        open_ = big.where(F.col("dense").isNull()).select("path", "set")
        # One row of tokens per set that goes on; copies have equal ones.
        tokens = cut(
            docs.where(F.col("size") > 0).join(open_.select("set").distinct(), "set", "left_semi").groupBy("set").agg(
                F.first("tokens").alias("tokens")
            ), "tokens",
        )
        nodes = _next_level(open_.join(tokens, "set").select("path", "set", "tokens"), similarity)
    return merged(cut(found.select("path", "set", "n"), "leaves"))


def _sliced_rows(n: str) -> Column:
    return F.col(n) * F.ceil(F.col(n) / F.lit(float(SLICE)))


def merged(leaves: DataFrame) -> DataFrame:
    """The leaves, with those that would be sliced merged where one larger leaf costs fewer rows than they do.

    A dense group of very many sets is found by every run and every token its sets share, each time nearly whole. A set names the
    first of its large leaves, and leaves whose sets mostly name the same one become one leaf of all their sets. A merged leaf
    has all pairs of its parts, so none is lost, and a pair is still compared once.
    """
    large = leaves.where(F.col("n") > SLICE)
    if large.isEmpty():
        return leaves
    large = cut(large, "large-leaves")
    first = cut(large.groupBy("set").agg(F.min("path").alias("first")), "first-leaves")
    named = large.join(first, "set").groupBy("path", "n", "first").agg(F.count(F.lit(1)).alias("sets"))
    onto = cut(
        named.groupBy("path", "n").agg(F.max_by("first", F.struct("sets", F.bitwise_not(F.col("first")))).alias("onto")), "merged-leaves"
    )
    union = cut(large.join(onto.select("path", "onto"), "path").select("onto", "set").distinct(), "merged-sets")
    apart = onto.groupBy("onto").agg(F.sum(_sliced_rows("n")).alias("apart"))
    cheaper = cut(
        union.groupBy("onto").agg(F.count(F.lit(1)).alias("all")).join(apart, "onto").where(_sliced_rows("all") < F.col("apart")),
        "cheaper-leaves",
    )
    replaced = onto.join(cheaper, "onto", "left_semi").select("path")
    joint = union.join(cheaper.select("onto", "all"), "onto").select(F.col("onto").alias("path"), "set", F.col("all").alias("n"))
    kept = leaves.where(F.col("n") <= SLICE).unionByName(large.join(replaced, "path", "left_anti"))
    return cut(kept.select("path", "set", "n").unionByName(joint), "leaves")


def _next_level(rows: DataFrame, similarity: float) -> DataFrame:
    def make():
        def run(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                paths = part.column(0).to_numpy().astype(np.int64).view(_U)
                tokens = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u4").reshape(-1, TOKENS)
                row, on = children(paths, tokens, similarity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(on.view(np.int64)), pa.array(part.column(1).to_numpy()[row])], names=["path", "set"]
                )

        return run

    return by_batch(rows, make, "path long, set long")


class _Lists:
    """A column of integer lists of one leaf."""

    def __init__(self, ends: np.ndarray, values: np.ndarray):
        self.ends, self.values = ends, values

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.ends[i] : self.ends[i + 1]]

    def __len__(self) -> int:
        return len(self.ends) - 1


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[dict]:
    """The columns of each run of rows with equal first ``n_keys`` columns, as arrays, across batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (rows if rest is None else pa.concat_tables([rest, rows])).combine_chunks()
        keys = np.stack([rows.column(k).to_numpy() for k in range(n_keys)])
        starts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        last = int(starts[-1]) if len(starts) else 0
        yield from _arrays(rows.slice(0, last), [0, *starts.tolist()])
        rest = rows.slice(last)
    if rest is not None:
        yield from _arrays(rest, [0, rest.num_rows])


def _arrays(rows: pa.Table, bounds: list[int]) -> Iterator[dict]:
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    flat, lists = {}, {}
    for name, column in zip(rows.column_names, rows.columns):
        chunk = column.chunk(0)
        if pa.types.is_list(chunk.type):
            lists[name] = (chunk.offsets.to_numpy(), chunk.values.to_numpy())
        else:
            flat[name] = chunk.to_numpy(zero_copy_only=False)
    for a, b in zip(bounds, bounds[1:]):
        yield {k: v[a:b] for k, v in flat.items()} | {k: _Lists(ends[a : b + 1], values) for k, (ends, values) in lists.items()}


def candidates(g: dict, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a leaf, or of two slices of it, that may reach the threshold and meet in no earlier leaf."""
    least = TOKENS * (1 + similarity) / 2 - DEVIATIONS * math.sqrt(TOKENS * (1 - similarity * similarity) / 4)
    a, b, size = g["sketch0"].view(_U), g["sketch1"].view(_U), g["size"].astype(np.float64)
    differ = np.bitwise_count(a[:, None] ^ a[None, :]).astype(np.int16) + np.bitwise_count(b[:, None] ^ b[None, :])
    near = (TOKENS - differ >= least) & (np.minimum(size[:, None], size[None, :]) >= similarity * np.maximum(size[:, None], size[None, :]) - 1e-9)
    if g["lo"][0] != g["hi"][0]:
        near &= g["slice"][:, None] != g["slice"][None, :]
    i, j = np.nonzero(np.triu(near, 1))
    if len(i):
        earlier = _share_earlier(g, np.unique(np.concatenate([i, j])))
        if earlier is not None:
            kept = ~earlier[i, j]
            i, j = i[kept], j[kept]
    return i, j


def _share_earlier(g: dict, rows: np.ndarray) -> np.ndarray | None:
    """For each two of the given rows whether they share a leaf before this one; None if none has any."""
    path, lists = g["path"][0], g["leaves"]
    before = [lists[r][lists[r] < path] for r in rows]
    if not any(map(len, before)):
        return None
    values, at, count = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    shared = count > 1
    row, at = np.repeat(rows, [len(x) for x in before])[shared[at]], (np.cumsum(shared) - 1)[at[shared[at]]]
    return _common(row, at, len(g["path"]), int(shared.sum())) > 0


def _common(row: np.ndarray, at: np.ndarray, n_rows: int, n_values: int) -> np.ndarray:
    """How many values each two rows share; ``row`` has value ``at``. Works on so many values at a time."""
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    common = np.zeros((n_rows, n_rows), np.float32)
    width = max(1, 4_000_000 // n_rows)
    for start in range(0, n_values, width):
        a, b = np.searchsorted(at, [start, start + width])
        part = np.zeros((n_rows, min(width, n_values - start)), np.float32)
        part[row[a:b], at[a:b] - start] = 1
        common += part @ part.T
    return common


def overlaps(shingles, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each two sets."""
    used = np.unique(np.concatenate([i, j]))
    if len(i) <= 4 * len(used):
        return np.array([len(np.intersect1d(shingles[a], shingles[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    at = np.unique(np.concatenate([shingles[r] for r in used]), return_inverse=True)[1].astype(np.int32)
    row = np.repeat(np.arange(len(used), dtype=np.int32), [len(shingles[r]) for r in used])
    shared = np.bincount(at) > 1
    kept = shared[at]
    row, at = row[kept], (np.cumsum(shared) - 1)[at[kept]]
    common = _common(row, at, len(used), int(shared.sum()))
    back = np.searchsorted(used, np.arange(used[-1] + 1))
    return common[back[i], back[j]].astype(np.int64)


def _linked(g: dict, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with links in a leaf, their numbers of linked documents, and the smallest set each is connected to."""
    i, j = candidates(g, similarity)
    if len(i):
        common = overlaps(g["shingles"], i, j)
        linked = common >= similarity * (g["size"][i] + g["size"][j] - common) - 1e-9
        i, j = i[linked], j[linked]
    m = len(g["path"])
    links = np.bincount(i, weights=g["copies"][j], minlength=m) + np.bincount(j, weights=g["copies"][i], minlength=m)
    order = np.argsort(np.argsort(g["set"], kind="stable"), kind="stable")
    low = order.copy()
    while len(i):
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = np.minimum(low, low[np.argsort(order, kind="stable")[low]])
        if (low == before).all():
            break
    rows = np.flatnonzero(links > 0)
    return rows, links[rows].astype(np.int64), np.sort(g["set"])[low[rows]]


def _sliced(leaves: DataFrame) -> DataFrame:
    """Rows of leaves, each as often as its slice meets a slice: ``(path, lo, hi, slice, set)``."""
    parts = F.ceil(F.col("n") / F.lit(float(SLICE))).cast("int")
    own = leaves.withColumn("parts", parts).withColumn("slice", F.pmod(F.xxhash64("set", "path"), F.col("parts")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return own.select("path", F.least("slice", "other").alias("lo"), F.greatest("slice", "other").alias("hi"), "slice", "set")


def link(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``(doc_id, class_id, n_links, class_set, text_key)``.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least
    ``similarity``; a text of fewer words has one shingle, of all of them. ``n_links`` counts the other documents
    linked to one, copies included. ``class_id`` is the smallest id in a document's connected component. A null or
    empty text has no links and is its own class. ``class_set`` is the smallest hash of a shingle set in the
    component, null for those; it tells classes apart where ids repeat. ``text_key`` is a hash of the text.
    """
    ship_package(docs.sparkSession)
    for seed in range(3):
        embedded = cut(_embedded(docs, similarity, seed), "embedded")
        some = embedded.where(F.col("size") > 0)
        sets = cut(some.groupBy("set").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("copies"),
            F.max("size").alias("size"), F.max("sketch0").alias("sketch0"), F.max("sketch1").alias("sketch1"),
            (F.min("check") != F.max("check")).alias("collides"),
        ).withColumns({"first_id": F.col("first.doc_id"), "first_key": F.col("first.text_key")}).drop("first"), "sets")
        if sets.where("collides").isEmpty():
            break
    else:
        raise RuntimeError("set hashes collide under every seed")
    sets = sets.drop("collides")

    leaves = _leaves(embedded, sets, similarity)
    lists = leaves.groupBy("set").agg(F.sort_array(F.collect_set("path")).alias("leaves"))
    known = cut(sets.join(lists, "set"), "set-leaves")
    sliced = _sliced(leaves)
    near = known.select("set", "size", "sketch0", "sketch1", "leaves")
    rows = sliced.join(near, "set").select("path", "lo", "hi", "slice", "set", "size", "sketch0", "sketch1", "leaves")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for g in _groups(batches, 3):
            if len(g["path"]) > 1:
                used = np.unique(np.concatenate(candidates(g, similarity)))
                if len(used):
                    out.append(np.stack([g[c][used] for c in ("path", "lo", "hi", "slice", "set")]))
            if len(out) >= 1000:
                yield _integers(out, ("path", "lo", "hi", "slice", "set"))
                out = []
        if out:
            yield _integers(out, ("path", "lo", "hi", "slice", "set"))

    grouped = lambda df: df.repartition("path", "lo", "hi").sortWithinPartitions("path", "lo", "hi")
    needed = cut(grouped(rows).mapInArrow(returning_memory(wanted), "path long, lo long, hi long, slice long, set long"), "meetings")
    shingled = cut(_shingles(docs, needed.select("set").distinct().join(sets.select("set", "first_id", "first_key"), "set"), seed), "shingles")
    full = needed.join(known.select("set", "size", "copies", "sketch0", "sketch1", "leaves"), "set").join(shingled, "set")
    full = full.select("path", "lo", "hi", "slice", "set", "size", "copies", "sketch0", "sketch1", "leaves", "shingles")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for g in _groups(batches, 3):
            if len(g["path"]) > 1:
                at, links, low = _linked(g, similarity)
                if len(at):
                    out.append(np.stack([g["set"][at], links, low]))
            if len(out) >= 1000:
                yield _integers(out, ("set", "links", "low"))
                out = []
        if out:
            yield _integers(out, ("set", "links", "low"))

    linked = cut(grouped(full).mapInArrow(returning_memory(compared), "set long, links long, low long"), "links")
    edges = linked.where(F.col("set") != F.col("low")).select(F.col("set").alias("src"), F.col("low").alias("dst"))
    members = connected_components(linked.select(F.col("set").alias("id")).distinct(), edges)
    members = cut(
        members.join(linked.groupBy(F.col("set").alias("id")).agg(F.sum("links").alias("links")), "id").join(
            sets.select(F.col("set").alias("id"), "first_id"), "id"
        ), "members",
    )
    named = cut(members.groupBy("component").agg(F.min("first_id").alias("class_id")), "classes")
    classes = cut(
        members.join(named, "component").select(F.col("id").alias("set"), F.col("component").alias("class_set"), "class_id", "links"),
        "set-classes",
    )
    of_set = cut(sets.join(classes, "set", "left").select(
        "set", F.coalesce("class_set", "set").alias("class_set"), F.coalesce("class_id", "first_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    ), "class-of-set")
    none = embedded.where(F.col("size") == 0).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("set").alias("class_set"), "text_key"
    )
    return some.select("doc_id", "set", "text_key").join(of_set, "set").select(
        "doc_id", "class_id", "n_links", "class_set", "text_key"
    ).unionByName(none)


def _integers(parts: list[np.ndarray], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(parts, axis=1).astype(np.int64)], names=list(names))


def _shingles(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """``(set, shingles)`` of the wanted sets, from the text of one document of each.

    Ids may repeat, so a text is found by its id and hash, and used only if it has the wanted set.
    """

    def make():
        def run(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                sets, found = [], []
                for wanted_set, text in zip(batch.column(0).slice(at, 1000).to_pylist(), batch.column(1).slice(at, 1000)):
                    shingles = shingle_hashes(text.as_py() or "", SHINGLE)
                    digest = xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes(), seed=seed)
                    if int.from_bytes(digest[:8], "little", signed=True) == wanted_set:
                        sets.append(wanted_set)
                        found.append(shingles)
                yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(found, pa.list_(pa.uint64())).cast(pa.list_(pa.int64()), safe=False)], names=["set", "shingles"])

        return run

    texts = docs.select(F.col("doc_id"), F.col("text").cast("string")).withColumn("text_key", F.xxhash64("text"))
    same = F.col("first_id").eqNullSafe(F.col("doc_id")) & (F.col("first_key") == F.col("text_key"))
    rows = wanted.join(texts, same).select("set", "text")
    found = by_batch(rows, make, "set long, shingles array<long>")
    # Repeated rows give a set several times.
    return found.groupBy("set").agg(F.first("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    return link(docs).drop("class_set", "text_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows, all columns, of one document of each class: that with the class's id.

    Of several rows with that id the class keeps one. Documents without words all stay.
    """
    found = link(docs).where(F.col("class_set").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")))
    # Ids may repeat with other texts, so a document is named by its id and a hash of its text.
    rows = found.groupBy("class_set", "class_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    chosen = cut(
        rows.groupBy("class_set", "class_id").agg(F.min(F.struct("text_key", "rows")).alias("of")).select("class_id", "of.*"), "kept"
    )
    key = F.xxhash64(F.col("text").cast("string"))
    has_words = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD)
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), key.alias("key"), has_words.alias("words"))
    of = lambda kept: packed.where("words").join(
        kept.select(F.col("class_id"), F.col("text_key")), F.col("id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("text_key")), "left_semi"
    )
    single, repeated = of(chosen.where("rows = 1")), of(chosen.where("rows > 1")).dropDuplicates(["id", "key"])
    return single.unionByName(repeated).unionByName(packed.where("NOT words")).select("doc.*")
