import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from kinweave.llm import collision_ann, jaccard_join
from kinweave.llm.common import shingle_hashes, words_of


def by_hand(rows, similarity=0.8):
    """Class and number of links of each row, by comparing all pairs."""
    sets = [set(shingle_hashes(text or "").tolist()) for _, text in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            common = len(sets[i] & sets[j])
            if common and common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[root(i)] = min(first.get(root(i), doc_id), doc_id)
    return sorted(((doc_id, first.get(root(i)), links[i]) for i, (doc_id, _) in enumerate(rows)), key=str)


def test_words_stand_between_ascii_spaces():
    for text in ("", " a\tb\nc\x0bd\x0ce\rf ", "a\x1cb", "a\xa0b c", "　 x  y"):
        assert words_of(text) == [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    assert len(shingle_hashes("a b c d e a b c d e")) == 5 and len(shingle_hashes("a b")) == 1 and len(shingle_hashes(" ")) == 0
    assert set(shingle_hashes("a b")) != set(shingle_hashes("b a"))


def test_runs_reach_the_target_recall():
    assert jaccard_join.runs_needed(0.999) >= jaccard_join.runs_needed(0.9) >= 1
    rnd = np.random.default_rng(0)
    tokens = rnd.integers(0, 1 << 32, (2, jaccard_join.TOKENS)).astype(np.uint32)
    same = rnd.random(jaccard_join.TOKENS) < 0.8
    tokens[1, same] = tokens[0, same]
    met = 0
    for run in range(300):
        paths = np.full(2, run + 1, np.uint64)
        row, on = jaccard_join.children(paths, tokens)
        met += bool(set(on[row == 0].tolist()) & set(on[row == 1].tolist()))
    assert met / 300 > 0.78


def documents_with_copies(spark, similar):
    rnd = random.Random(similar)
    base = [f"w{rnd.randrange(400)}" for _ in range(90)]
    rows = []
    for i in range(similar):
        words = list(base)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(9999)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:30] + [f"u{rnd.randrange(10**6)}" for _ in range(40)])) for i in range(60)]
    rows += [(2000 + i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 7)))) for i in range(60)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_links_and_classes_equal_all_pairs(spark, monkeypatch):
    """A dense group larger than a slice, texts sharing a passage, short texts with many ties."""
    monkeypatch.setattr(jaccard_join, "SLICE", 40)
    monkeypatch.setattr(jaccard_join, "SMALL", 20)
    rows, docs = documents_with_copies(spark, 150)
    found = sorted(map(tuple, jaccard_join.near_duplicates(docs).collect()), key=str)
    assert found == by_hand(rows)


def test_large_leaves_of_the_same_sets_are_merged(spark, monkeypatch):
    """Two clusters found by several runs each, and a leaf that shares sets with both but costs less alone."""
    monkeypatch.setattr(jaccard_join, "SLICE", 10)
    rnd = random.Random(1)
    held = {p: set(rnd.sample(range(60), 50)) for p in (3, 5, 7, -4)} | {p: set(rnd.sample(range(100, 150), 40)) for p in (1, 9)}
    held |= {20: set(range(5)), 21: set(range(140, 260))}
    leaves = spark.createDataFrame([(p, s, len(sets)) for p, sets in held.items() for s in sets], "path long, set long, n long")
    found = {}
    for r in jaccard_join.merged(leaves).collect():
        found.setdefault((r.path, r.n), set()).add(r.set)
    assert all(n == len(sets) for (_, n), sets in found.items())
    assert all(any(sets <= whole for whole in found.values()) for sets in held.values())
    assert {p for p, _ in found} == {-4, 1, 20, 21}
    nothing = leaves.limit(0)
    assert jaccard_join.merged(nothing).count() == 0


def test_sliced_rows_of_near_copies_found_by_all_runs(spark, monkeypatch):
    """One large group makes about as many rows as its slices need once, not once per run and token."""
    monkeypatch.setattr(jaccard_join, "SLICE", 20)
    monkeypatch.setattr(jaccard_join, "SMALL", 10)
    _, docs = documents_with_copies(spark, 150)
    made, sliced = [], jaccard_join._sliced
    monkeypatch.setattr(jaccard_join, "_sliced", lambda leaves: made.append((leaves, sliced(leaves))) or made[-1][1])
    jaccard_join.near_duplicates(docs).count()
    leaves, rows = made[0]
    large = leaves.where("n > 20").select("path", "n").distinct().collect()
    assert rows.where(F.col("set").isin([r.set for r in leaves.where("n > 20").select("set").distinct().collect()])).count() < 20 * 150 * 8
    assert sum(r.n > 100 for r in large) <= 2


def test_join_of_awkward_rows(spark):
    docs = edge.documents(spark)
    rows = [(r[0], r[1]) for r in edge.rows()]
    found = sorted(map(tuple, jaccard_join.near_duplicates(docs).select("doc_id", "class_id", "n_links").collect()), key=str)
    assert found == by_hand(rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 5 stands for 6 and the two rows of 7, 10 for 11; texts without words stay; both texts under 8 stay.
    gone = [6, 7, 7, 11]
    want = [r[0] for r in edge.rows()]
    for i in gone:
        want.remove(i)
    assert ids == sorted(want, key=str)
    assert jaccard_join.near_duplicates(edge.empty(spark)).count() == 0
    assert jaccard_join.one_of_each(edge.empty(spark)).count() == 0


def test_repeated_row_of_the_kept_document(spark):
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g"), (5, "x y z")]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_are_not_paired(spark, monkeypatch, doc_id):
    fetched, by_batch = [], jaccard_join.by_batch

    def counted(df, make, schema):
        if "shingles" in schema:
            fetched.append(df.count())
        return by_batch(df, make, schema)

    monkeypatch.setattr(jaccard_join, "by_batch", counted)
    rows = [(doc_id, text) for _, text in documents_with_copies(spark, 40)[0][:40]]
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == by_hand(rows)
    assert len(fetched) == 1 and 1 < fetched[0] <= len(rows)


def vectors(spark, n=900, dims=16):
    rnd = np.random.default_rng(1)
    centers = rnd.standard_normal((8, dims))
    data = (centers[rnd.integers(0, 8, n)] + 0.7 * rnd.standard_normal((n, dims))).astype(np.float32)
    data[5] = data[4]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)]
    rows += [(n, None, 0), (n + 1, [0.0] * dims, 0), (n + 2, [float("nan")] * dims, 0), (n + 3, [None] + [1.0] * (dims - 1), 0), (n + 4, [float("inf")] * dims, 0)]
    rows += [rows[7], (None, [1.0] * dims, 0)]
    return data.astype(np.float64), spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").withColumn("rank", F.lit(1))


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(collision_ann, "BLOCK_ROWS", 500)
    monkeypatch.setattr(collision_ann, "QUERY_ROWS", 30)
    monkeypatch.setattr(collision_ann, "TIMES", 3)
    data, frame = vectors(spark)
    found = {}
    for r in collision_ann.twentieth(frame).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    queries = [i for i in range(len(data)) if i % 20 == 0]
    assert sorted(found) == queries
    hits = 0
    for q in queries:
        score = data @ data[q]
        order = [i for i in np.lexsort((np.arange(len(data)), -score)) if i != q][:20]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert [g[2] for g in got] == pytest.approx([score[g[1]] for g in got], abs=1e-12)
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        hits += len({g[1] for g in got} & set(order))
    assert hits / (20 * len(queries)) >= 0.9


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in collision_ann.search(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0)]
    assert collision_ann.twentieth(few.limit(0)).count() == 0
    assert collision_ann.twentieth(few.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("lengths", ["log-normal", "one long"])
def test_neighbours_of_vectors_of_different_lengths(spark, lengths):
    rnd = np.random.default_rng(2)
    data = rnd.standard_normal((40, 32))[rnd.integers(0, 40, 8_000)] + 2.5 * rnd.standard_normal((8_000, 32))
    data /= np.linalg.norm(data, axis=1)[:, None]
    data *= np.exp(0.2 * rnd.standard_normal(8_000))[:, None] if lengths == "log-normal" else np.where(np.arange(8_000) == 7, 10.0, 1.0)[:, None]
    frame = spark.createDataFrame(list(enumerate(data.tolist())), "vec_id long, embedding array<double>")
    found = {}
    for r in collision_ann.search(frame, frame.where("vec_id % 200 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 8_000, 200):
        score = data @ data[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits / (20 * 40) >= 0.95


def test_ranges_of_lengths_share_blocks_only_if_all_are_verified(monkeypatch):
    monkeypatch.setattr(collision_ann, "BLOCK_ROWS", 1_000)
    low, first, many = collision_ann.layout({-2: 100, -1: 200, 0: 2_500, 3: 50, 4: 400}, 20)
    assert (low, first.tolist(), many.tolist()) == (-2, [0, 0, 1, 0, 0, 4, 5], [1, 1, 3, 0, 0, 1, 1])
    assert collision_ann.layout({}, 20)[1:] == (np.zeros(1), np.zeros(1))


def test_an_id_is_found_once_per_query_id(spark):
    """Rows of one id with different vectors: the best score of any counts, ranks go on without repeats."""
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.9, 0.1]), (1, [0.1, 0.5]), (2, [0.2, 0.8]), (3, [0.5, 0.5]), (3, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [(r["rank"], r.vec_id, round(r.score, 4)) for r in collision_ann.twentieth(df).orderBy("rank").collect()]
    assert found == [(1, 1, 0.9), (2, 2, 0.8), (3, 3, 0.5)]
