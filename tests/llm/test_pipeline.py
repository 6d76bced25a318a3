import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import edge
from test_joins import by_hand
from kinweave.llm import secret_scan, toxicity
from kinweave.session import write_and_read


def test_stages_have_their_effects(spark, tmp_path):
    """Each stage on what the one before it kept, against plain Python."""
    insult = [(300 + i, f"{'you dimwit ' if i % 2 else 'you friend '} {'plain words here now '.join(str(i) * 3)}", "en", "a", 1) for i in range(160)]
    labels = spark.createDataFrame([(r[0], 1, r[0] % 2) for r in insult], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([*edge.rows(), *insult], edge.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = write_and_read(stage(spark, docs, str(tmp_path)), f"{tmp_path}/{name}")
        tables.append(docs)
    raw, clean, single, blank, mixed, encoded = ([tuple(r) for r in t.collect()] for t in tables)
    assert all(t.columns == columns for t in tables[:5])

    model = toxicity.train(tables[0], labels)
    assert sorted(map(str, clean)) == sorted(str(r) for r in raw if model.score(r[1]) < 0.5)
    assert not any(r[1] and "dimwit" in r[1] for r in clean) and len(clean) < len(raw) - 60

    texts = Counter(r[1] for r in single if r[1] and r[1].strip())
    assert max(texts.values()) == 1 and {r[1] for r in single} <= {r[1] for r in clean}
    classes = {doc_id: class_id for doc_id, class_id, _ in by_hand([(r[0], r[1]) for r in clean])}
    assert {r[0] for r in single} == set(classes.values())

    known = secret_scan.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ranks = secret_scan.ranked(known, secret_scan.learned(tables[2]))
    want = [secret_scan.redact(r[1], secret_scan.find(r[1], ranks=ranks)[1]) if r[1] else r[1] for r in single]
    assert sorted(map(str, (r[1] for r in blank))) == sorted(map(str, want)) and not any("AKIA" in (r[1] or "") for r in blank)

    assert {r[1] for r in mixed} <= {r[1] for r in blank} and max(Counter(map(str, mixed)).values()) <= 3
    assert sorted(r[3] for r in encoded) == sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in mixed)

    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(encoded, key=str)


def test_empty_corpus(spark, tmp_path):
    edge.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
