"""URL filter: host and path rules first, then the likelihood ratio of two character language models.

The URLs that the rules decide teach two variable-order Markov models, one of accepted and one of rejected URLs; the models
see whole URLs, a null one as empty.
Their counts stand in one table of n-grams with a column per model. A URL without a rule is judged by the mean
difference, per character, of the logarithms of its probabilities, against a threshold calibrated on a fold of the
decided URLs that taught nothing. Probabilities are computed once per distinct n-gram. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, Window as W

from kinweave.session import cut, observed

#: Characters of context of the longest n-grams, and symbols a character is drawn from before anything is known.
CONTEXT, ALPHABET = 4, 256
#: Fixed values: ``(host and path, verdict)``.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The share of a fold of this many kept for calibration is one.
FOLDS = 5
#: Scores are rounded to this many digits where the threshold is sought, and to more where they are compared.
GRID, DIGITS = 2, 9
#: Different URLs that one task cuts into n-grams.
TEXTS_PER_TASK = 2_000
#: N-grams that are cut from a text together.
PIECE = 64
_BEGIN, _END = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, with A to Z in lower case, and path of a URL; both empty without ``://`` or for null."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one. The rules are part of the plan."""
    rule = verdict = F.lit(None).cast("string")
    for text, action in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def grams(text: Column) -> Column:
    """For each character of a text and its end, that character after the ``CONTEXT`` ones before it."""
    # A place in a text is found by counting characters from its start, so places are sought in short overlapping pieces.
    pieces = F.regexp_extract_all(
        F.concat(F.lit(_BEGIN * CONTEXT), text, F.lit(_END)),
        F.lit(f"(?s)(?=(.{{{CONTEXT + 1},{PIECE + CONTEXT}}})).{{1,{PIECE}}}"), F.lit(1),
    )
    return F.flatten(F.transform(pieces, lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - CONTEXT), lambda i: F.substring(p, i, CONTEXT + 1)
    )))


def counts(taught: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(gram, a, r)``: occurrences by model of all n-grams of all orders, and ``(context, na, ta, nr, tr)``.

    The occurrences are counted for the longest n-grams; the shorter ones are the sums of those that end in them.
    """
    full = taught.select(F.explode(grams(F.col("text"))).alias("g"), "accepted").groupBy("g").agg(
        F.sum("accepted").alias("a"), F.sum(1 - F.col("accepted")).alias("r")
    )
    ends = F.array(*[F.expr(f"right(g, {n})") for n in range(1, CONTEXT + 2)])
    by_gram = cut(full.select(F.explode(ends).alias("gram"), "a", "r").groupBy("gram").agg(
        F.sum("a").alias("a"), F.sum("r").alias("r")
    ), "url-grams")
    by_context = by_gram.groupBy(F.expr("left(gram, length(gram) - 1)").alias("context")).agg(
        F.sum("a").alias("na"), F.sum((F.col("a") > 0).cast("long")).alias("ta"),
        F.sum("r").alias("nr"), F.sum((F.col("r") > 0).cast("long")).alias("tr"),
    )
    return by_gram, by_context


def log_ratios(wanted: DataFrame, by_gram: DataFrame, by_context: DataFrame) -> DataFrame:
    """``(g, ratio)`` for distinct longest n-grams: log probability if accepted less that if rejected.

    Orders are interpolated from the shortest up, each weighted by its count against the number of different
    characters seen after its context; an unseen context passes on the shorter one's probability.
    """
    orders = F.array(*[
        F.struct(F.lit(n).alias("n"), F.expr(f"right(g, {n})").alias("gram"), F.expr(f"left(right(g, {n}), {n - 1})").alias("context"))
        for n in range(1, CONTEXT + 2)
    ])
    rows = wanted.select("g", F.explode(orders).alias("o")).select("g", "o.*").join(by_gram, "gram", "left")
    # Every n-gram has the empty context; its counts are one row and go into the plan.
    empty = by_context.where(F.col("context") == "").first()
    first = rows.where("n = 1").withColumns({c: F.lit(empty[c] if empty else 0) for c in ("na", "ta", "nr", "tr")})
    rows = first.unionByName(rows.where("n > 1").join(by_context, "context", "left").select(first.columns))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c)
    steps = F.array_sort(F.collect_list(F.struct("n", *[zero(c) for c in ("a", "na", "ta", "r", "nr", "tr")])))

    def interpolated(seen: str, total: str, kinds: str) -> Column:
        def step(p: Column, o: Column) -> Column:
            return F.when(o[total] + o[kinds] > 0, (o[seen] + o[kinds] * p) / (o[total] + o[kinds])).otherwise(p)

        return F.aggregate("steps", F.lit(1.0 / ALPHABET), step)

    return rows.groupBy("g").agg(steps.alias("steps")).select(
        "g", (F.ln(interpolated("a", "na", "ta")) - F.ln(interpolated("r", "nr", "tr"))).alias("ratio")
    )


def _key() -> Column:
    return F.struct(F.xxhash64("text").alias("x"), F.md5("text").alias("m"))


def spread(texts: DataFrame, n: int) -> DataFrame:
    """``n`` texts dealt evenly to as many tasks as cutting them into n-grams is worth.

    By a hash of their own, so that the exchange is not taken for one that is there already.
    """
    return texts.repartition(max(1, math.ceil(n / TEXTS_PER_TASK)), F.xxhash64("text", F.lit(1)))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` for every row; ``score`` is null where a rule decides.

    If the decided URLs show only one verdict, or none, every score is 0 and so is the threshold: such URLs are
    allowed.
    """
    host, path = parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("text"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("decided"), "text")
    decided = rows.where(F.col("decided").isNotNull())
    open_ = rows.where(F.col("decided").isNull()).withColumn("key", _key())

    in_fold = F.conv(F.substring(F.md5("text"), 1, 4), 16, 10).cast("int") % FOLDS == 0
    taught = decided.select("text", (F.col("decided") == "allow").cast("long").alias("accepted"), in_fold.alias("fold"))
    by_gram, by_context = counts(taught.where(~F.col("fold")).select("text", "accepted"))
    # Each text that needs a score once: those without a rule, and the calibration fold with its verdicts.
    calibration = taught.where(F.col("fold")).groupBy("text").agg(
        F.sum("accepted").alias("a"), F.sum(1 - F.col("accepted")).alias("r")
    )
    seen = Observation()
    texts = cut(open_.select("text").distinct().select("text", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("r")).unionByName(
        calibration
    ).observe(seen, F.count(F.lit(1)).alias("n")), "url-texts")
    uses = spread(texts, observed(seen, texts, "n")[0]).select(_key().alias("key"), "a", "r", F.explode(grams(F.col("text"))).alias("g"))
    ratios = cut(log_ratios(uses.select("g").distinct(), by_gram, by_context), "url-ratios")
    scored = cut(
        uses.join(ratios, "g").groupBy("key").agg(
            F.round(F.sum("ratio") / F.count(F.lit(1)), DIGITS).alias("score"), F.max("a").alias("a"), F.max("r").alias("r")
        ), "url-scores",
    )
    both = by_gram.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("r"), F.lit(0)).alias("r")).first()
    if not (both["a"] and both["r"]):
        scored = scored.withColumn("score", F.lit(0.0))
        limit = 0.0
    else:
        limit = threshold(scored)
    found = open_.join(scored.where(F.col("a") + F.col("r") == 0).select("key", "score"), "key").select(
        id_col, "host", "path", "rule", F.when(F.col("score") >= limit, "allow").otherwise("block").alias("verdict"), "score"
    )
    return decided.select(
        id_col, "host", "path", "rule", F.col("decided").alias("verdict"), F.lit(None).cast("double").alias("score")
    ).unionByName(found)


def threshold(scored: DataFrame) -> float:
    """The score from which a URL is allowed: the best balanced accuracy on the calibration fold, 0 without one.

    Scores are rounded first, so the table searched has as many rows as the grid has values.
    """
    grid = scored.where(F.col("a") + F.col("r") > 0).groupBy(F.round("score", GRID).alias("at")).agg(
        F.sum("a").alias("a"), F.sum("r").alias("r")
    )
    up, every = W.orderBy("at").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    rate = lambda part, whole: F.when(F.col(whole) > 0, part / F.col(whole)).otherwise(0.5)
    grid = grid.withColumns({"all_a": F.sum("a").over(every), "all_r": F.sum("r").over(every)}).withColumns({
        "below_a": F.coalesce(F.sum("a").over(up), F.lit(0)), "below_r": F.coalesce(F.sum("r").over(up), F.lit(0)),
    })
    right = F.round(rate(F.col("all_a") - F.col("below_a"), "all_a") + rate(F.col("below_r"), "all_r"), DIGITS)
    best = grid.agg(F.max_by("at", F.struct(right, -F.abs("at"), "at")).alias("at")).first()["at"]
    return 0.0 if best is None else best - 0.5 * 10**-GRID


def verdicts(pages: DataFrame) -> DataFrame:
    """:func:`judge` without the scores."""
    return judge(pages).drop("score")


def _interpolated(n: int, side: str) -> str:
    """SQL for the probability of the last character of ``g`` after ``n - 1`` characters, from the shorter one's."""
    before = f"(SELECT 1.0::DOUBLE / {ALPHABET})" if n == 1 else f"p.p{side}"
    return (
        f"CASE WHEN coalesce(x.n{side} + x.t{side}, 0) > 0 THEN (coalesce(c.{side}, 0) + x.t{side} * {before})"
        f" / CAST(x.n{side} + x.t{side} AS DOUBLE) ELSE {before} END AS p{side}"
    )


_ORDERS = ",\n".join(
    f"""order{n} AS (
    SELECT p.g, {_interpolated(n, "a")}, {_interpolated(n, "r")}
    FROM {"wanted" if n == 1 else f"order{n - 1}"} p
    LEFT JOIN counted c ON c.gram = right(p.g, {n}) LEFT JOIN contexts x ON x.context = left(right(p.g, {n}), {n - 1}))"""
    for n in range(1, CONTEXT + 2)
)

ORACLE = rf"""
WITH cut AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path, coalesce(url, '') AS text
    FROM pages),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM cut),
decided AS (
    SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' ELSE 'block' END AS said,
           CAST('0x' || substr(md5(text), 1, 4) AS INTEGER) % {FOLDS} = 0 AS held
    FROM ruled WHERE rule IS NOT NULL),
taught AS (SELECT text, CAST(said = 'allow' AS INTEGER) AS accepted FROM decided WHERE NOT held),
fives AS (
    SELECT substr(repeat(chr(2), {CONTEXT}) || text || chr(3), i, {CONTEXT + 1}) AS g, accepted
    FROM (SELECT text, accepted, unnest(range(1, length(text) + 2)) AS i FROM taught)),
counted AS (
    SELECT right(g, n) AS gram, sum(accepted) AS a, sum(1 - accepted) AS r
    FROM fives, range(1, {CONTEXT + 2}) AS orders(n) GROUP BY 1),
contexts AS (
    SELECT left(gram, length(gram) - 1) AS context, sum(a) AS na, count(*) FILTER (a > 0) AS ta,
           sum(r) AS nr, count(*) FILTER (r > 0) AS tr
    FROM counted GROUP BY 1),
texts AS (
    SELECT text, 0 AS a, 0 AS r FROM ruled WHERE rule IS NULL GROUP BY text
    UNION ALL SELECT text, sum(CAST(said = 'allow' AS INTEGER)), sum(CAST(said = 'block' AS INTEGER)) FROM decided WHERE held GROUP BY text),
uses AS (
    SELECT text, a, r, substr(repeat(chr(2), {CONTEXT}) || text || chr(3), i, {CONTEXT + 1}) AS g
    FROM (SELECT text, a, r, unnest(range(1, length(text) + 2)) AS i FROM texts)),
wanted AS (SELECT DISTINCT g FROM uses),
{_ORDERS},
scored AS (
    SELECT text, max(a) AS a, max(r) AS r, round(sum(ln(pa) - ln(pr)) / count(*), {DIGITS}) AS score
    FROM uses JOIN order{CONTEXT + 1} USING (g) GROUP BY text),
grid AS (SELECT round(score, {GRID}) AS spot, sum(a) AS a, sum(r) AS r FROM scored WHERE a + r > 0 GROUP BY 1),
rated AS (
    SELECT spot, round(
        CASE WHEN sum(a) OVER () > 0 THEN (sum(a) OVER () - coalesce(sum(a) OVER w, 0)) / CAST(sum(a) OVER () AS DOUBLE) ELSE 0.5 END +
        CASE WHEN sum(r) OVER () > 0 THEN coalesce(sum(r) OVER w, 0) / CAST(sum(r) OVER () AS DOUBLE) ELSE 0.5 END, {DIGITS}) AS rate
    FROM grid WINDOW w AS (ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT spot FROM rated ORDER BY rate DESC, abs(spot), spot DESC LIMIT 1),
known AS (SELECT (SELECT sum(accepted) FROM taught) > 0 AND (SELECT sum(1 - accepted) FROM taught) > 0 AS both_sides)
SELECT page_id, host, path, rule, said AS verdict FROM decided
UNION ALL
SELECT page_id, host, path, rule,
       CASE WHEN NOT coalesce((SELECT both_sides FROM known), false)
                 OR score >= coalesce((SELECT spot - 0.5::DOUBLE * 0.01::DOUBLE FROM best), 0) THEN 'allow' ELSE 'block' END
FROM ruled JOIN (SELECT text, score FROM scored WHERE a + r = 0) USING (text) WHERE rule IS NULL
"""
