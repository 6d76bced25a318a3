import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import edge
from kinweave.llm import line_runs
from kinweave.session import bucketed, discarded

SPACE = " \t\n\x0b\x0c\r"


def by_hand(texts, copies=10, min_chars=1):
    """``(lines, lines gone, text kept)`` of each text."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    lines = [(t or "").split("\n") for t in texts]
    met = Counter(k for ls in lines for k in {key(line) for line in ls})
    gone = {k for k, n in met.items() if n >= copies and len(k) >= min_chars}
    kept = [[line for line in ls if key(line) not in gone] for ls in lines]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(lines, kept)]


def awkward():
    """Lines that differ in case and white space only, runs of them, copies, texts of nothing else."""
    rnd = random.Random(9)
    lines = ["Home | About", "\tHOME | about \r", "ÄRGER", "ärger", "", "  ", "日本", "a", "x" * 4000, "\x0bA\x0c", "\xa0a"] + [f"line {i}" for i in range(30)]
    texts = ["\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 12))) for _ in range(120)]
    return texts + ["a\n" * 3000 + "end"] + ["copy of a text\nHome | About"] * 25 + [None, "", "\n", "\n\n"]


@pytest.mark.parametrize("copies, min_chars", [(10, 1), (3, 2), (1, 0), (10_000, 1)])
def test_lines_of_awkward_texts(spark, copies, min_chars):
    texts = awkward()
    docs = spark.createDataFrame([(None if i % 3 else i // 6, t, i) for i, t in enumerate(texts)], "doc_id long, text string, i int").repartition(5)
    for name in ("pos", "key", "h1", "t1", "n", "batch", "marks", "gone", "lines"):
        docs = docs.withColumn(name, F.lit("x"))
    found = line_runs.dedup(docs, ["i"], copies=copies, min_chars=min_chars).collect()
    assert [tuple(r)[1:] for r in sorted(found, key=lambda r: r.doc.i)] == by_hand(texts, copies, min_chars)


def test_digest_of_edge_rows(spark):
    rows = edge.rows() + [(500 + i, "same line\nother " + str(i), "en", "s", 1) for i in range(10)]
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    for name in edge.EXTRA:
        docs = docs.withColumn(name, F.lit("x"))
    want = [(r[0], n, d, hashlib.sha256(t.encode()).hexdigest()) for r, (n, d, t) in zip(rows, by_hand([r[1] for r in rows]))]
    assert sorted(map(str, map(tuple, line_runs.per_document(docs).collect()))) == sorted(map(str, want))
    assert line_runs.per_document(edge.empty(spark)).count() == 0


def test_runs_count_over_batches(spark):
    """At most one run a level, whole counts below the threshold, a repeated line stored no further."""
    rnd = random.Random(4)
    batches = [[rnd.randint(0, 60) for _ in range(40)] + [7] * 12 for _ in range(11)]
    with discarded(spark):
        runs = line_runs.LineRuns(spark, copies=12, buckets=3)
        for batch in batches:
            counts = spark.createDataFrame(list(Counter(batch).items()), "h1 long, n long").select("h1", F.lit(0).cast("long").alias("h2"), "n")
            runs.add(counts)
            assert sum(r is not None for r in runs.levels) == bin(batches.index(batch) + 1).count("1")
        whole = {r.h1: r.n for r in runs.compacted().collect()}
    total = Counter(x for batch in batches for x in batch)
    assert set(whole) == set(total) and {k for k, n in whole.items() if n >= 12} == {k for k, n in total.items() if n >= 12}
    assert all(whole[k] == n for k, n in total.items() if n < 12) and whole[7] < total[7]


def test_runs_meet_without_exchange(spark):
    with discarded(spark):
        run = lambda: bucketed(spark.range(50).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).cast("long").alias("n")), "r", line_runs.HASH, 3)
        a, b = run(), run()
        for how, right in (("left_anti", b.select(*line_runs.HASH)), ("full", b.withColumnRenamed("n", "m"))):
            plan = a.join(right.hint("merge"), line_runs.HASH, how)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("r_")]


def test_plan_has_no_python(spark):
    plan = line_runs.per_document(edge.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
