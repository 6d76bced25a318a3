import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

import edge
from kinweave.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, longest):
    ws = words(text)
    return [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def by_hand(docs, target, longest=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    """``(id, n_features, weight, score, drawn)`` of ``(id, text)`` rows, and the ranks' order."""
    found = [[crc32(f.encode()) % buckets for f in runs(text, longest)] for _, text in docs]
    s = Counter(b for f in found for b in f)
    t = Counter(crc32(f.encode()) % buckets for text in target for f in runs(text, longest))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for (doc_id, text), f in zip(docs, found):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(f), weight, score, len(words(text)) >= min_words))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = order[: percent * len(order) // 100]
    ranks = Counter((r[:4], i + 1) for i, r in enumerate(drawn))
    return [r[:4] for r in out], ranks


def compare(found, docs, target, **options):
    rows, ranks = by_hand(docs, target, **options)
    got = [((r.doc.doc_id, r.n_features, r.weight, r.score), r["rank"]) for r in found]
    assert Counter(r for r, _ in got) == Counter(rows)
    ties = lambda pairs: sorted(((r[3], r[0] is None, r[0], rank) for (r, rank) in pairs), key=str)
    assert ties((r, k) for r, k in got if k is not None) == ties(ranks.elements())


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97, "seed": 7, "min_words": 1, "percent": 40}, {"buckets": 1 << 17, "percent": 100}, {"percent": 0}])
def test_rows_as_by_hand(spark, options):
    rows = edge.rows() + [(900, edge.rows()[4][1], "en", "s", 1)] * 30 + [(None, None, "en", "s", 1)] * 20
    rows += [(901 + i, "É\x00ß a_b C-3 ÀBİx 日本 x~y `q` {z} 9:30 " * (i % 5), "en", "s", 1) for i in range(40)]
    target = ["日本 z q 9 " * 4, None, "", edge.rows()[3][1][:5000]]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    for name in ("rank", "score", "weight", "n", "bucket", "doc", "found", "own"):
        docs = docs.withColumn(name, F.lit("x"))
    aim = spark.createDataFrame([(str(i), t, "x") for i, t in enumerate(target)], "item_id string, text string, doc string")
    found = importance.resample(docs, aim, ["doc_id", "rank"], **options).collect()
    assert all(r.doc["rank"] == "x" for r in found)
    compare(found, [(r[0], r[1]) for r in rows], target, **options)


def test_empty_tables(spark):
    docs, none = edge.documents(spark), spark.createDataFrame([], "item_id string, text string")
    assert importance.per_document(edge.empty(spark), none).count() == 0
    compare(importance.resample(docs, none, ["doc_id"]).collect(), [(r[0], r[1]) for r in edge.rows()], [])


def test_offsets_of_windows():
    text = importance.lowered("A b--Ç\x00d E")
    found = list(importance.features(importance.splitter()(text), 2))
    assert found == [("a", 0, 1), ("b", 2, 3), ("Ç", 5, 6), ("d", 7, 8), ("e", 9, 10), ("a b", 0, 3), ("b Ç", 2, 6), ("Ç d", 5, 8), ("d e", 7, 10)]
    assert all(" ".join(words(text[a:b])) == f for f, a, b in found)


def test_words_as_by_pattern():
    """Every code point is split as the pattern says, also in a very long text."""
    every = "".join(f"a{chr(c)}b " for c in range(0x3000) if not 0xD800 <= c < 0xE000)
    split = importance.splitter()
    assert [w for w, _ in split(importance.lowered(every))] == words(every)
    long = "word " * 300_000 + "x" * 500_000
    assert len(split(long)) == 300_001


def test_ranks_over_many_equal_rows(spark):
    """Repeated rows and equal scores get ranks without gaps; no range holds them all."""
    rows = [(1, "a " * 30)] * 500 + [(i, "b " * 30) for i in range(2, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = importance.per_document(docs, docs.limit(0)).collect()
    ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
    assert ranks == list(range(1, len(rows) // 10 + 1))
