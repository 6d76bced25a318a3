"""Resampling documents towards a target distribution by hashed word features.

The tokenizers library's untrained Split finds the words of a text, lower-cased in ASCII, with their offsets; windows over
the offset pairs give the features, runs of consecutive words. A feature's bucket is its CRC-32 modulo the number of buckets.
Histograms of all documents and of all target texts give each bucket a gain, the logarithm of how much more frequent it
is in the target; a document weighs the mean gain of its features. Gumbel noise from a hash of the id is added to the
weight, and the highest scores are drawn, which is sampling without replacement.

A text is read once: what is kept of it is the list of its buckets, in bytes. The highest scores are ranked from a count
per score and a range partitioning, so no task holds all that is drawn.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kinweave.llm.common import by_batch
from kinweave.session import cut, discarded

#: Runs of code points that are neither ASCII signs, white space nor capitals.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, SEED = 10_000, 2024
#: Documents with at least so many words can be drawn, and so many percent of them are.
MIN_WORDS, PERCENT = 20, 10
#: Drawn rows ranked by one task, on average.
ROWS_PER_RANGE = 1_000_000
#: Words whose buckets a worker remembers, and characters cut into words at a time.
REMEMBERED, PIECE = 1 << 17, 1 << 20


def splitter() -> Callable[[str], list[tuple[str, tuple[int, int]]]]:
    """The words of a text with their offsets, by the tokenizers library."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True).pre_tokenize_str


def lowered(text: str) -> str:
    return text.encode("utf-8", "replace").lower().decode("utf-8")


def features(words: list[tuple[str, tuple[int, int]]], longest: int = 1) -> Iterator[tuple[str, int, int]]:
    """``(feature, start, end)`` of all runs of 1 to ``longest`` consecutive words, joined by one space."""
    for n in range(1, longest + 1):
        for first, last in zip(range(len(words)), words[n - 1 :]):
            yield " ".join(w for w, _ in words[first : first + n]), words[first][1][0], last[1][1]


class _Buckets(dict):
    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[feature] = crc32(feature.encode("utf-8")) % self.buckets
        return value


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucketed_texts(docs: DataFrame, carry: Column, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``(doc, n_words, found)``: the columns in the struct ``carry``, the number of words, the buckets of all features in bytes.

    A null text has no words.
    """
    rows = docs.select(carry.alias("doc"), F.col(text_col).cast("string").alias("text"))

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        split, known = splitter(), _Buckets(buckets)

        def one(text: str | None) -> tuple[int, bytes]:
            if not text:
                return 0, b""
            words = split(lowered(text))
            runs = [w for w, _ in words] if longest == 1 else [f for f, _, _ in features(words, longest)]
            return len(words), np.fromiter(map(known.__getitem__, runs), _width(buckets), len(runs)).tobytes()

        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts, done = rows.column("text"), 0
            while done < rows.num_rows:
                size, out = 0, []
                while done + len(out) < rows.num_rows and size < PIECE:
                    text = texts[done + len(out)].as_py()
                    size += len(text or "")
                    out.append(one(text))
                part = rows.slice(done, len(out))
                done += len(out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array([n for n, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())],
                    names=["doc", "n_words", "found"],
                )

        return batch

    return by_batch(rows, make, f"doc {rows.schema['doc'].dataType.simpleString()}, n_words long, found binary")


def histogram(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all texts; a task counts its own first."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = np.frombuffer(b"".join(rows.column("found").to_pylist()), _width(buckets))
            counts = np.bincount(found, minlength=buckets)
            met = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["bucket", "n"])

        return batch

    return by_batch(texts.select("found"), make, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` for every bucket: the floored thousandfold logarithm of smoothed frequencies, target to documents."""
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    mine, theirs = histogram(docs, buckets).withColumnRenamed("n", "mine"), histogram(target, buckets).withColumnRenamed("n", "theirs")
    whole = W.partitionBy()  # a row per bucket
    plus = lambda n, more: F.coalesce(n, F.lit(0)).cast("double") + more
    total = lambda n: plus(F.sum(n).over(whole), buckets)
    ratio = plus("theirs", 1) * total("mine") / (plus("mine", 1) * total("theirs"))
    counts = every.join(mine, "bucket", "left").join(theirs, "bucket", "left")
    return counts.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def weighted(texts: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc, n_words, n_features, weight)``: the floored mean gain of a text's features, 0 without any."""
    width = _width(len(gain))
    schema = f"doc {texts.schema['doc'].dataType.simpleString()}, n_words long, n_features long, weight long"

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.frombuffer(b, width) for b in rows.column("found").to_pylist()]
            weights = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            columns = [rows.column("doc"), rows.column("n_words"), pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "n_features", "weight"])

        return batch

    return by_batch(texts, make, schema)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Floored thousandfold Gumbel noise from a hash of the id; a null id counts as the word ``null``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(float(1 << 32)))))


def ranked(scored: DataFrame, eligible: Column, percent: int, id_col: Column) -> DataFrame:
    """``scored`` with ``rank``: 1 for the highest ``score`` of the eligible rows, down to ``percent`` of them; else null.

    Ties go to the smaller id, null ids last. ``scored`` is a written table. A count per score, a whole number of which there are
    few, says from which score on rows can be drawn; only these are sorted, in ranges that also split
    repeated rows, and a row's rank is its place in its range after the rows of the ranges before.
    """
    counts = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    down = W.orderBy(F.desc("score"))  # one row per score
    held = counts.select("score", F.sum("n").over(down).alias("above"), F.sum("n").over(W.partitionBy()).alias("all"))
    drawn = F.floor(F.col("all") * percent / 100)
    least = held.where(drawn > 0).groupBy("all").agg(F.max(F.when(F.col("above") >= drawn, F.col("score"))).alias("least")).first()
    none = F.lit(None).cast("long").alias("rank")
    if least is None:
        return scored.select("*", none)
    wanted = least["all"] * percent // 100
    inside = F.coalesce(eligible, F.lit(False)) & (F.col("score") >= least["least"])
    parts = max(1, math.ceil(wanted / ROWS_PER_RANGE))
    order = [F.desc("score"), id_col.asc_nulls_last(), "_row"]
    placed = scored.where(inside).withColumn("_row", F.monotonically_increasing_id())
    placed = cut(placed.repartitionByRange(max(parts, 8), *order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    starts = sizes.select(F.col("_part"), (F.sum("n").over(W.orderBy("_part")) - F.col("n")).alias("_start"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) + F.col("_start")
    top = placed.join(F.broadcast(starts), "_part").select(*scored.columns, place.cast("long").alias("rank"))
    top = top.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return top.unionByName(scored.where(~inside).select("*", none))


def resample(
    docs: DataFrame, target: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", longest: int = 1,
    buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``(doc, n_words, n_features, weight, score, rank)``, one row per row of ``docs``; ``rank`` is null for what is not drawn.

    ``doc`` holds the columns named in ``carry``. Null texts have no words; a document without features weighs 0.
    Ids may be null or repeat: such rows share their noise, and fully equal rows get ranks next to each other.
    """
    struct = F.struct(F.col(id_col).alias("_id"), F.struct(*carry).alias("own"))
    with discarded(docs.sparkSession):
        texts = cut(bucketed_texts(docs, struct, text_col, longest, buckets), "feature-buckets")
        wanted = cut(bucketed_texts(target, F.struct(F.lit(0).alias("_id")), text_col, longest, buckets), "target-buckets")
        gain = np.zeros(buckets, np.int64)
        for row in gains(texts, wanted, buckets).collect():  # a row per bucket
            gain[row["bucket"]] = row["gain"]
        scored = weighted(texts, gain).withColumn("score", F.col("weight") + noise(F.col("doc._id"), seed))
        scored = cut(scored, "scored", outlives=True)
    out = ranked(scored, F.col("n_words") >= min_words, percent, F.col("doc._id"))
    return out.select(F.col("doc.own").alias("doc"), "n_words", "n_features", "weight", "score", "rank")


def per_document(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target, ["doc_id"]).select(F.col("doc.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wanted AS (
    SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
crc AS (
    SELECT list(list_reduce(list_prepend(n, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                            lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab
    FROM (SELECT unnest(range(256)) AS n)),
f AS (SELECT r, unnest(w) AS word FROM words),
t AS (SELECT unnest(w) AS word FROM wanted),
every AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM (SELECT word FROM f UNION ALL SELECT word FROM t)),
bucket AS (
    SELECT word, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % 10000 AS bucket
    FROM every, crc),
mine AS (SELECT bucket, count(*) AS s FROM f JOIN bucket USING (word) GROUP BY bucket),
theirs AS (SELECT bucket, count(*) AS t FROM t JOIN bucket USING (word) GROUP BY bucket),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM f) + 10000.0::DOUBLE)
           / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
    FROM mine FULL JOIN theirs USING (bucket)),
sums AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
    SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:8] AS BIGINT)
               + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM words LEFT JOIN sums USING (r)),
placed AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (r)
"""
