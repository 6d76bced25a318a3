"""Line deduplication over levelled sorted runs of line hashes.

The index of lines is a set of runs: tables of ``(h1, h2, n)``, the 128-bit hash of a line's key and the number of documents
it was met in, bucketed and sorted by hash. Two runs of one level are merged into a run of the next, so there are
never more than one per level. A new batch of documents is anti-joined, by merging, against what the runs hold as repeated
often enough already, and adds the rest as a run of its own. All runs and batches are bucketed alike: neither the
anti-joins nor the merges shuffle anything.

Lines that are repeated often enough over all documents are then removed from each. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kinweave.session import bucketed, cut, discarded, observed

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
#: Lines in a bucket of a run, on average, from which on more buckets are made.
ROWS_PER_BUCKET = 2_000_000


class LineRuns:
    """The levelled index: ``add`` takes a batch, ``compacted`` gives one run of everything.

    ``copies`` is the number of documents from which on a line counts as repeated; once a run holds a line that
    often, later batches do not store it again, so its count is then a lower bound. To be used inside ``discarded``.
    """

    def __init__(self, spark: SparkSession, copies: int, buckets: int):
        self.spark, self.copies, self.buckets = spark, copies, buckets
        self.levels: list[DataFrame | None] = []

    def _written(self, run: DataFrame, placed: bool = True) -> DataFrame:
        return bucketed(run, "line-run", HASH, self.buckets, placed=placed)

    def add(self, batch: DataFrame, placed: bool = False) -> None:
        """Add ``(h1, h2, n)``, a row per line of the batch; ``placed`` says that it is bucketed like the runs."""
        for run in filter(None, self.levels):
            known = run.where(F.col("n") >= self.copies).select(*HASH)
            batch = (batch if placed else batch.repartition(self.buckets, *HASH)).join(known.hint("merge"), HASH, "left_anti")
            placed = True
        self._stack(self._written(batch.select(*HASH, "n"), placed), 0)

    def _merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.join(b.withColumnRenamed("n", "m").hint("merge"), HASH, "full")
        return self._written(both.select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")))

    def _stack(self, run: DataFrame, level: int) -> None:
        while level < len(self.levels) and self.levels[level] is not None:
            run, self.levels[level] = self._merged(self.levels[level], run), None
            level += 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = run

    def compacted(self) -> DataFrame:
        """All runs merged into one, the smallest first."""
        runs = [r for r in self.levels if r is not None]
        whole = runs[0] if runs else self.spark.createDataFrame([], "h1 long, h2 long, n long")
        for run in runs[1:]:
            whole = self._merged(run, whole)
        self.levels = [None] * len(self.levels) + [whole]
        return whole


def line_keys(text: Column) -> Column:
    """The keys of a text's lines: ASCII letters small, white space at both ends gone."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)))


def _hashes(key: str, names: Sequence[str] = HASH) -> list[Column]:
    return [F.xxhash64(key).alias(names[0]), F.xxhash64(F.lit(1), key).alias(names[1])]


def repeated_lines(docs: DataFrame, copies: int, min_chars: int, batches: int, text_col: str = "text") -> DataFrame:
    """``(h1, h2)`` of the keys found in ``copies`` documents or more, by way of the runs.

    Every row is a document of its own, also where ids repeat; a key counts once per document. ``docs`` are
    dealt to ``batches`` by a hash of the text and counted in one pass.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = docs.select(F.pmod(F.xxhash64(text), F.lit(batches)).cast("int").alias("batch"), F.explode(F.array_distinct(line_keys(text))).alias("key"))
    seen = Observation()
    with discarded(docs.sparkSession):
        counts = cut(
            lines.where(F.length("key") >= min_chars).select("batch", *_hashes("key")).groupBy("batch", *HASH)
            .agg(F.count(F.lit(1)).alias("n")).observe(seen, F.count(F.lit(1)).alias("rows")),
            "line-counts",
        )
        buckets = max(8, math.ceil(observed(seen, counts, "rows")[0] / ROWS_PER_BUCKET))
        dealt = bucketed(counts, "line-batches", HASH, buckets, partition_by=("batch",))
        runs = LineRuns(docs.sparkSession, copies, buckets)
        for batch in range(batches):
            runs.add(dealt.where(F.col("batch") == batch).drop("batch"), placed=True)
        return cut(runs.compacted().where(F.col("n") >= copies).select(*HASH), "repeated-lines", outlives=True)


def dedup(
    docs: DataFrame, carry: Sequence[str], text_col: str = "text", copies: int = 10, min_chars: int = 1, batches: int = 4
) -> DataFrame:
    """``(doc, n_lines, n_dropped, kept)``, one row per row of ``docs``; ``doc`` holds the columns named in ``carry``.

    A line goes if its key, of at least ``min_chars`` code points, is found in ``copies`` documents or more; ``kept`` is
    what stays, joined by line ends. A null or empty text is one empty line, which stays. Nothing but the text
    decides, so rows with equal or null ids are all judged alike. What goes is found once per different text, on narrow
    rows; the texts themselves are shuffled once, to meet it.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    place = ["t1", "t2"]
    with discarded(docs.sparkSession):
        repeated = repeated_lines(docs, copies, min_chars, batches, text_col)
        lines = docs.select(*_hashes(text, place), F.posexplode(line_keys(text)).alias("pos", "key")).where(F.length("key") >= min_chars)
        gone = lines.select(*place, "pos", *_hashes("key")).join(repeated, HASH, "left_semi").groupBy(*place).agg(
            F.array_sort(F.collect_set("pos")).alias("gone")
        )
        # Marks up to the last line that goes, so that a line's mark is found by its place.
        gap = lambda pos, i: pos - F.coalesce(F.get("gone", i - 1), F.lit(-1)) - 1
        marks = F.flatten(F.transform("gone", lambda pos, i: F.concat(F.array_repeat(F.lit(False), gap(pos, i)), F.array(F.lit(True)))))
        gone = cut(gone.select(*place, F.size("gone").cast("long").alias("n_dropped"), marks.alias("marks")), "lines-gone", outlives=True)
    rows = docs.select(F.struct(*carry).alias("doc"), text.alias("text"), *_hashes(text, place)).join(gone, place, "left")
    split = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(split, lambda line, i: ~F.coalesce(F.get("marks", i), F.lit(False))), "\n")
    return rows.select(
        "doc", F.size(split).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("marks").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


def per_document(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` for lines found in ten documents or more."""
    return dedup(docs, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
