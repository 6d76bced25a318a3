import math
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import cover_quantize

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, parts=4, entries=256, rounds=4):
    """``(vec_id, label, codes, error)`` by comparing every part with every entry, and the codebooks."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = sorted(((i, label, [math.floor(1024 * x) for x in v]) for i, v, label in fine), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not whole:
        return [], []
    d = len(whole[0][2]) // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[cut(r[2], p) for r in whole[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((apart(v, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for r in whole:
                members[nearest(cut(r[2], p), books[p])[1]].append(cut(r[2], p))
            for k, vs in members.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for i, label, v in whole:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, [k for _, k in best], sum(e for e, _ in best)))
    return out, books


def vectors(n, dims, seed, clusters=6):
    """Clustered vectors with repeats, ties, zeros and far ones."""
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        v = [x + rnd.gauss(0, 0.02) for x in rnd.choice(centres)]
        if i % 7 == 0:
            v = [round(4 * x) / 4 for x in v]
        rows.append((i * 3 % n, v, rnd.choice([None, 1, 2])))
    return rows + [(n, [0.0] * dims, 1)] * 3 + [(n + 1, [50.0] * dims, None), (n + 2, [-0.0001] * dims, 2)]


AWKWARD = [
    (7, None, 1), (8, [None] * 8, 1), (9, [float("nan")] + [0.0] * 7, 2), (10, [float("inf")] * 8, None), (None, [0.5] * 8, None),
    (11, [0.5] * 8, 3), (11, [0.25] * 8, 3), (11, [0.25] * 8, 3),
]


@pytest.mark.parametrize("rows, dims, entries", [
    (vectors(260, 8, 1) + AWKWARD, 8, 16), (vectors(120, 4, 2), 4, 256), (AWKWARD, 8, 2), (AWKWARD[:4], 8, 4), ([], 8, 4),
])
def test_codes_and_books_as_by_hand(spark, rows, dims, entries):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("id", "v", "x", "docs", "trees", "error", "codes"):
        df = df.withColumn(name, F.lit("x"))
    found, books = cover_quantize.compress(df, ["vec_id", "label", "error"], entries=entries)
    want, want_books = by_hand(rows, entries=entries)
    got = [(r.doc.vec_id, r.doc.label, r.codes, r.error) for r in found.collect()]
    assert Counter(map(str, got)) == Counter(map(str, want))
    if want:
        assert books.tolist() == want_books


def test_digest_columns(spark):
    rows = vectors(300, 8, 3) + AWKWARD
    want, books = by_hand(rows)
    per_label = Counter()
    for _, label, _, error in want:
        per_label[label] += error
    digest = sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    expected = [(i, "".join(f"{k:02x}" for k in codes), error, per_label[label], digest) for i, label, codes, error in want]
    found = cover_quantize.per_vector(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(str, map(tuple, found))) == Counter(map(str, expected))


def test_trees_cover_and_spare_comparisons():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(size=(12, 6))[rng.integers(0, 12, 1500)] * 5000 + rng.normal(size=(1500, 6)) * 40).astype(np.int64)
    points[:50] = points[0]
    tree = cover_quantize.build(points)
    assert sorted(tree["order"]) == list(range(1500)) and (points[tree["order"]] == tree["points"]).all()
    for lo, hi, centre, radius in zip(tree["lo"], tree["hi"], tree["centres"], tree["radius"]):
        assert (np.sqrt(((tree["points"][lo:hi] - centre) ** 2).sum(axis=1)) <= radius + 1e-9).all()
    entries = points[rng.integers(0, 1500, 30)] + rng.integers(-20, 20, (30, 6))
    found, error = cover_quantize.labels(tree, entries)
    apart = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    ranges = [(lo, hi) for lows, highs, _ in cover_quantize.assign(tree, entries[:8]) for lo, hi in zip(lows, highs)]
    assert sum(hi - lo for lo, hi in ranges) == 1500 and len(ranges) < 700


def test_vectors_that_cannot_be_cut(spark):
    for rows in ([(1, [1.0] * 6, 1)], [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1e30] * 4, 1)]):
        with pytest.raises(ValueError):
            cover_quantize.compress(spark.createDataFrame(rows, SCHEMA), ["vec_id"])
