"""Mixing sources to target weights along a time-varying curriculum.

Each source's share of all words follows from its weight, bounded by how often its documents may repeat. Over the
course of training a source's rate changes linearly; integrating it gives the cumulative demand for its words, and
inverting that gives the training position at which each of its documents is due. Within a source, documents are
taken in the order of a hash of their id and text, as often as the target asks for.

Running sums over a source are taken in two steps, per hash range and within a range. Rows that are alike in all that is carried are
one counted row in them, and rows without words stay outside, so no task ever holds a whole source or id. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kinweave.llm.common import WORD
from kinweave.session import cut

#: Documents in a hash range of a source, on average.
ROWS_PER_RANGE = 2_000


def targets(sizes: DataFrame, weights: Sequence[float], slopes: Sequence[float], cap: float) -> DataFrame:
    """``(source, n, source_size, rank, target, slope)`` of ``(source, size)`` rows.

    Sources in code point order, null last, get ``weights`` and ``slopes`` in turn. All words are shared by weight;
    what a source would get beyond ``cap`` times its own size is shared among the others by weight, again and
    again. That ends where every source gets the same multiple of its weight or its cap, so the sources are
    sorted by the multiple that fills their cap and the multiple is found from running sums. One row per source.
    """
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") - 1) % len(values) + 1)
    one = W.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(one)).withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
    per = per.withColumn("cap", F.lit(float(cap)) * F.col("source_size").cast("double")).withColumn("full", F.col("cap") / F.col("weight"))
    every = W.partitionBy()
    filled = W.orderBy("full", "rank").rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))
    per = per.withColumn("multiple", rest / open_weight)
    settled = F.when(F.col("multiple") <= F.col("full"), F.struct("full", "rank", "multiple"))
    per = per.withColumn("level", F.min(settled).over(every)["multiple"])
    return per.select(
        "source", "n", "source_size", "rank",
        F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"), "slope",
    )


def due(u: Column, slope: Column) -> Column:
    """The time in [0, 1] by which the share ``u`` of a source's demand has come up.

    The rate at time t is ``1 + slope * (2 t - 1)`` of the mean; its integral is ``t + slope * (t * t - t)``.
    """
    root = F.sqrt((F.lit(1.0) - slope) * (F.lit(1.0) - slope) + F.lit(4.0) * slope * u)
    return F.when(slope == 0.0, u).otherwise((slope - F.lit(1.0) + root) / (F.lit(2.0) * slope))


def mix(
    docs: DataFrame, carry: Sequence[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3), slopes: Sequence[float] = (-0.5, 0.0, 0.5), cap: float = 3.0,
) -> DataFrame:
    """One row per document: ``(doc, size, source_size, target, taken, starts)``.

    ``doc`` holds the columns named in ``carry``, which are moved several times and so had better be narrow. A source's documents stand
    in a circle, in hash order; the mix takes ``target`` words, rounded, from its start, so a document may be taken several
    times and the last one in part. ``taken`` counts a document's words with repeats, ``starts`` are the training
    positions, in words of the whole mix, at which it is due. Documents without words take no part; a null text has none. Ids may
    be null or repeat.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), text))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    # The texts are read once; sizes and places are narrow.
    rows = cut(docs.select(F.struct(*carry).alias("doc"), F.col(source_col).alias("_source"), key.alias("key"), size.alias("size")), "sizes")
    # Written, so that its size is known and the join below is a broadcast only if it is small.
    shares = cut(targets(rows.select(F.col("_source").alias("source"), "size"), weights, slopes, cap).withColumn(
        "total", F.sum("source_size").over(W.partitionBy())
    ), "shares")
    of_source = ["rank", "source_size", "target", "slope", "total"]
    known = rows.join(shares, F.col("_source").eqNullSafe(F.col("source"))).select("doc", "key", "size", "n", *of_source)
    # Rows alike are one row with their number, per partition of the scan.
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    kinds = known.where("size > 0").withColumn("part", F.spark_partition_id()).groupBy("doc", "key", "size", "part", "n", *of_source).agg(
        F.count(F.lit(1)).alias("copies")
    ).withColumn("range", F.floor(place * F.ceil(F.col("n") / F.lit(float(ROWS_PER_RANGE)))).cast("long"))
    kinds = cut(kinds, "kinds")
    words = F.col("size") * F.col("copies")
    per = kinds.groupBy("rank", "range").agg(F.sum(words).alias("words"))
    before = (F.sum("words").over(W.partitionBy("rank").orderBy("range")) - F.col("words")).alias("range_start")
    placed = kinds.join(per.select("rank", "range", before), ["rank", "range"])
    within = W.partitionBy("rank", "range").orderBy("key", "size", F.xxhash64("doc"), "part").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumn("first", F.col("range_start") + F.sum(words).over(within) - words).drop("range_start")
    # Each of the rows alike stands behind the one before; many of them are first dealt to other tasks.
    alike = placed.where("copies > 1").repartition("key", "part")
    alike = alike.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    single = placed.where("copies = 1").unionByName(alike.withColumn("first", F.col("first") + F.col("nth") * F.col("size")).drop("nth"))
    want = F.round("target").cast("long")
    rounds = F.floor(want / F.col("source_size")).cast("long")
    rest = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), want - rounds * F.col("source_size") - F.col("first")))
    single = single.withColumns({"want": want, "rounds": rounds, "rest": rest})
    times = (F.col("rounds") + (F.col("rest") > 0).cast("long")).cast("int")
    start = lambda p: due(
        ((p * F.col("source_size") + F.col("first")) / F.nullif("want", F.lit(0))).cast("double"), F.col("slope")
    ) * F.col("total").cast("double")
    none = F.array().cast("array<double>")
    starts = F.when(times > 0, F.transform(F.sequence(F.lit(0), times - 1), start)).otherwise(none)
    out = ["doc", "size", "source_size", "target"]
    return single.select(
        *out, (F.col("size") * F.col("rounds") + F.col("rest")).alias("taken"), starts.alias("starts")
    ).unionByName(known.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken"), none.alias("starts")))


def per_document(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_position)``, range-sorted by first position, unused ones last."""
    return mix(docs, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.get("starts", F.lit(0)).alias("first_position"),
    ).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, with repeats, in the order of their training positions.

    Texts stay whole: a last, partial taking counts if it is at least half of the document.
    """
    row = ["_h1", "_h2"]
    known = docs.select("*", F.xxhash64(*docs.columns).alias("_h1"), F.xxhash64(F.lit(1), *docs.columns).alias("_h2"))
    # Positions are found on hashes of the rows; the rows themselves come in once, at the end.
    mixed = cut(mix(known, row).where("taken > 0"), "mixed")
    whole = F.round(F.col("taken") / F.col("size")).cast("int")
    taken = cut(mixed.select("doc.*", F.explode(F.slice("starts", 1, whole)).alias("_at")), "takings")
    repeated = cut(mixed.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc.*"), "repeated-rows")
    if not repeated.isEmpty():
        known = known.join(repeated, row, "left_anti").unionByName(known.join(repeated, row, "left_semi").dropDuplicates(row))
    return known.join(taken, row).orderBy("_at", *row).select(*docs.columns)


ORACLE = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents),
per AS (
    SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS slope,
           CAST((rank - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS cap
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
          FROM d GROUP BY source)),
filled AS (
    SELECT *, cap / weight AS fill,
           (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS multiple
    FROM per WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
    SELECT source, source_size, slope, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
           least(cap, weight * (SELECT arg_min(multiple, (fill, rank)) FROM filled WHERE multiple <= fill)) AS target
    FROM filled),
ranged AS (
    SELECT d.doc_id, d.size, s.source_size, s.target, s.slope, s.total, CAST(round(s.target) AS BIGINT) AS want,
           CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS first
    FROM d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
used AS (
    SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS rounds,
           greatest(0, least(size, want - CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END * source_size - first)) AS rest
    FROM ranged)
SELECT doc_id, size, source_size, target, CAST(size * rounds + rest AS BIGINT) AS taken,
       CASE WHEN size > 0 AND (rounds > 0 OR rest > 0) THEN total * CASE WHEN slope = 0 THEN first / want
           ELSE (slope - 1.0::DOUBLE + sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope) + 4.0::DOUBLE * slope * (first / want))) / (2.0::DOUBLE * slope) END
       END AS first_position
FROM used
"""
