"""Quality rules, line first: lines that fail a rule go, then documents that lost too much go.

Everything is an expression on the row of a document: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"

#: A line longer than this many characters is never boilerplate, whatever it names.
BOILERPLATE_CHARS = 200
BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|(accept|use) (all )?cookies|"
    r"(enable|requires) javascript|lorem ipsum|click here|read more|sign (in|up)|log ?in|subscribe (now|to)|powered by|"
    r"back to top|skip to (main )?content|share (this|on)|follow us)\b"
)
SENTENCE_END = r"[.!?…。！？]"
#: Words in a line from which a sentence is expected; and, per word, the separators, marks and shouts that are too many.
SENTENCE_WORDS = 12
SEPARATORS, SEPARATORS_PER_WORD, SEPARATORS_MIN = r"[|»›·•]", 0.2, 3
MARKS, MARKS_PER_WORD = r"[#*$%&<>\\{}~^]", 0.3
SHOUTS, SHOUTS_PER_WORD, SHOUTS_MIN = r"!!", 0.3, 3
#: Share of the characters in lines that may go before the document goes.
MAX_LOSS = 0.5


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks one of the rules."""
    words = F.regexp_count(line, F.lit(SPACE_RUN)) + 1
    many = lambda pattern, share: F.regexp_count(line, F.lit(pattern)) >= words * F.lit(float(share))
    at_least = lambda pattern, n: F.regexp_count(line, F.lit(pattern)) >= n
    boilerplate = (F.length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    navigation = line.rlike(SEPARATORS) & at_least(SEPARATORS, SEPARATORS_MIN) & many(SEPARATORS, SEPARATORS_PER_WORD)
    marks = line.rlike(MARKS) & many(MARKS, MARKS_PER_WORD)
    shouts = line.rlike(SHOUTS) & at_least(SHOUTS, SHOUTS_MIN) & many(SHOUTS, SHOUTS_PER_WORD)
    no_sentence = ~line.rlike(SENTENCE_END) & (words >= SENTENCE_WORDS)
    return boilerplate | navigation | marks | shouts | no_sentence


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned)`` per document.

    Words stand between spaces, tabs and line ends; a null text has none. ``n_repeat_words`` counts the words
    covered by windows of eight words that occur twice or more in the text. Window hashes tell the texts without
    any such window; only the others compare the windows themselves. ``cleaned`` is the text without its failing
    lines. A document is kept unless it breaks a base rule, or more than ``MAX_LOSS`` of the characters in its
    lines stood in failing ones.
    """
    df = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    trimmed = F.btrim("_text", F.lit(SPACES))
    df = df.withColumn("_words", F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN, -1)).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(NO_SPACE))
    df = df.withColumns({"_n": F.size("_words").cast("long"), "_lines": lines})
    window = lambda i: F.slice(F.col("_words"), i, 8)
    starts = F.sequence(F.lit(1), (F.col("_n") - 7).cast("int"))
    df = df.withColumns({
        "_hashes": F.when(F.col("_n") > 8, F.transform(starts, lambda i: F.xxhash64(window(i)))),
        "_good": F.filter("_lines", lambda line: ~line_fails(line)),
    })
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    sorted_windows = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(window(i), " ").alias("s"), i.alias("i"))))
    df = df.withColumn("_windows", F.when(F.coalesce(repeats, F.lit(False)), sorted_windows))
    same = lambda x, k: F.coalesce(F.get("_windows", k)["s"] == x["s"], F.lit(False))
    again = F.filter("_windows", lambda x, k: same(x, k - 1) | same(x, k + 1))
    df = df.withColumn("_again", F.array_sort(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        "_again", F.struct(F.lit(0).alias("n"), F.lit(-8).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(8), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"].cast("long"),
    )
    df = df.withColumns({
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        "_all_chars": F.length(F.array_join("_lines", "")), "_good_chars": F.length(F.array_join("_good", "")),
    })
    base_failed = (F.col("_n") < 20) | (F.col("n_repeat_words") * 100 > F.col("_n") * 30)
    lost_too_much = F.col("_good_chars") < F.col("_all_chars") * F.lit(1.0 - MAX_LOSS)
    return df.select(
        id_col, F.col("_n").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & ~lost_too_much).alias("kept"),
        F.array_join("_good", "\n").alias("cleaned"),
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """:func:`assess` without the cleaned texts."""
    return assess(docs).drop("cleaned")


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM documents),
win AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS x(k) GROUP BY r),
judged AS (
    SELECT r, l, len(regexp_extract_all(l, '[\x20\x09-\x0D]+')) + 1 AS words
    FROM (SELECT r, unnest(lines) AS l FROM d)),
bad AS (
    SELECT r, CAST(sum(length(l)) AS BIGINT) AS n FROM judged
    WHERE (length(l) <= 200 AND regexp_matches(l, '%(boilerplate)s'))
       OR (len(regexp_extract_all(l, '[|\x{BB}\x{203A}\x{B7}\x{2022}]')) >= greatest(3, words * 0.2::DOUBLE))
       OR (regexp_matches(l, '[#*$%%&<>\\{}~^]') AND len(regexp_extract_all(l, '[#*$%%&<>\\{}~^]')) >= words * 0.3::DOUBLE)
       OR (len(regexp_extract_all(l, '!!')) >= greatest(3, words * 0.3::DOUBLE))
       OR (NOT regexp_matches(l, '[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}]') AND words >= 12)
    GROUP BY r),
counted AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
           length(array_to_string(lines, '')) AS all_chars, coalesce(b.n, 0) AS bad_chars
    FROM d LEFT JOIN covered c USING (r) LEFT JOIN bad b USING (r)),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND all_chars - bad_chars >= all_chars * 0.5::DOUBLE AS kept
FROM based
""" % {"boilerplate": BOILERPLATE}
