"""Pairs inside a block whose texts are alike, without comparing everybody with everybody.

A Jaro-Winkler similarity of at least t bounds from below how many characters two texts of given lengths and a given
common beginning must share. Such texts share, beside the beginning, some of their rarest characters: every text is filed
under the combinations of those, and only texts filed under the same one are compared.

Texts repeat, within a block and from block to block. So different texts of one part are filed, each once, and rows meet by the
pairs found. The other parts are compared for rows that meet and share enough characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, comb

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, functions as F

from kinweave.functions.similarity import BOOST_ABOVE, PREFIX_MAX, PREFIX_WEIGHT, jaro_winkler
from kinweave.operators.skew import SLICE_ROWS, sliced_join
from kinweave.session import cut, exchanged, observed

# Texts of more characters are compared with all texts of the block whose length allows it.
FILED_LENGTH = 64
# Characters of a combination, by the length of the common beginning; fewer where they would make too many combinations.
CHARACTERS = (3, 2, 2, 1, 1)
COMBINATIONS = 64
# The commonest letters last: combinations of rare ones meet seldom. Any order gives the same pairs.
COMMON_LAST = "qxzjkvwbyghfpmcudltsirnoae"
SLACK = 1e-9
OUT_ROWS = 8_192
# Texts filed by a task: each becomes many entries, so few bytes of texts are much work.
TASK_TEXTS = 2_000
# Pairs made by a task of a join that makes far more rows than it reads.
TASK_PAIRS = 10_000_000
# What filing a text, and what letting two rows meet, costs in pairs of texts within reach of each other's entries.
FILING, MEETING = 100_000, 100
ADDED = ("key", "start", "chosen", "rarest")

Part = tuple[Column, float]


def least_jaro(threshold: float, beginning: int) -> float:
    """The Jaro similarity two texts with ``beginning`` equal leading characters need, to be this similar with the bonus."""
    bonus = PREFIX_WEIGHT * beginning
    return max(BOOST_ABOVE, (threshold - bonus) / (1 - bonus)) - SLACK


def least_common(threshold: float, beginning: int, longer: int, shorter: int) -> int | None:
    """The characters two texts of these lengths must share to be this similar, or None if they cannot be.

    With m matched characters Jaro is at most ``(m / longer + m / shorter + 1) / 3``.
    """
    need = ceil((3 * least_jaro(threshold, beginning) - 1) * longer * shorter / (longer + shorter) - SLACK)
    return need if need <= shorter else None


def _characters(text: str) -> list[str]:
    """Each character with the number of times it has occurred, rarest first."""
    seen: dict[str, int] = {}
    out = []
    for c in text:
        seen[c] = seen.get(c, 0) + 1
        out.append((COMMON_LAST.find(c.lower()), c, seen[c]))
    return [f"{c}{n}" for _, c, n in sorted(out)]


@lru_cache(maxsize=None)
def _ways(threshold: float, n: int, as_longer: bool) -> list[tuple[int, int, int, int, int]]:
    """``(longer, shorter, beginning, need, k)``: how a text of ``n`` characters is filed for the lengths and beginnings it may meet."""
    ways = []
    for other in range(1, n + 1) if as_longer else range(n, FILED_LENGTH + 1):
        longer, shorter = (n, other) if as_longer else (other, n)
        for p in range(min(PREFIX_MAX, shorter) + 1):
            need = least_common(threshold, p, longer, shorter)
            if need is None:
                continue
            k = max(0, min(CHARACTERS[p], need - p))
            while k > 1 and comb(longer - need + k, k) > COMBINATIONS:
                k -= 1
            ways.append((longer, shorter, p, need, k))
    return ways


def filed_under(text: str, threshold: float, as_longer: bool) -> Iterator[tuple[str, int, list[str], list[str]]]:
    """``(key, beginning, combination, rarest)`` of each entry of a text that meets shorter texts (``as_longer``) or longer.

    Two different texts that reach the threshold have one key in common for each combination their ``rarest`` share.
    """
    n = len(text)
    if n > FILED_LENGTH and as_longer or not as_longer and n >= least_partner(threshold):
        yield "long", 0, [], []
    if n == 0 or n > FILED_LENGTH:
        return
    rest = [_characters(text[p:]) for p in range(PREFIX_MAX + 1)]
    for longer, shorter, p, need, k in _ways(threshold, n, as_longer):
        rarest = rest[p][: n - need + k]
        for chosen in combinations(rarest, k):
            yield f"{longer}:{shorter}:{p}:{text[:p]}:{' '.join(chosen)}", p, list(chosen), rarest


def least_partner(threshold: float) -> int:
    """The least length of a text that can be this similar to one beyond ``FILED_LENGTH``."""
    # All of the shorter text is matched: Jaro is at most (2 + shorter / longer) / 3.
    return ceil((3 * least_jaro(threshold, PREFIX_MAX) - 2) * (FILED_LENGTH + 1) - SLACK)


def bag(text: str) -> Column:
    """A bit for each character of the column with the number of times it has occurred; null beyond ``FILED_LENGTH``."""
    so_far, c = f"substr({text}, 1, i)", f"substr({text}, i, 1)"
    bit = f"pmod(hash({c}, length({so_far}) - length(replace({so_far}, {c}, ''))), 64)"
    bits = f"aggregate(sequence(1, length({text})), 0L, (bits, i) -> bits | shiftleft(1L, {bit}))"
    return F.expr(f"CASE WHEN length({text}) = 0 THEN 0L WHEN length({text}) <= {FILED_LENGTH} THEN {bits} END")


def may_reach(threshold: float, text_l: str, text_r: str, bag_l: str, bag_r: str) -> Column:
    """False for texts whose lengths, bags and common beginning keep them below the threshold."""
    n, m = F.length(text_l), F.length(text_r)
    # Each bit that one side alone has is a character, or several, that the other side lacks.
    alone = [F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(b))) for a, b in ((bag_l, bag_r), (bag_r, bag_l))]
    shared = F.coalesce(F.least(n - alone[0], m - alone[1]), F.least(n, m))
    needs = [F.lit(3 * least_jaro(threshold, p) - 1) for p in range(PREFIX_MAX + 1)]
    exact = needs[0]
    for p in range(1, PREFIX_MAX + 1):
        exact = F.when(F.substring(text_l, 1, p) == F.substring(text_r, 1, p), needs[p]).otherwise(exact)
    # The longest beginning asks for least, and is tried without looking at the texts.
    return reduce(Column.__and__, [shared * (n + m) >= least * n * m - SLACK * (n + m) for least in (needs[-1], exact)])


def _filed(texts: DataFrame, threshold: float, as_longer: bool, side: str) -> DataFrame:
    """The entries of each row's ``text``; columns ``<name>_<side>``."""
    names = [f"{c}_{side}" for c in texts.columns]
    text = texts.columns.index("text")

    def entries(batches):
        for batch in batches:
            rows, keys, starts, chosen, rarest = [], [], [], [], []

            def made():
                columns = [pc.array_take(c, pa.array(rows, pa.int64())) for c in batch.columns]
                columns += [pa.array(keys, pa.string()), pa.array(starts, pa.int32())]
                columns += [pa.array(chosen, pa.list_(pa.string())), pa.array(rarest, pa.list_(pa.string()))]
                return pa.RecordBatch.from_arrays(columns, names=[*names, *(f"{c}_{side}" for c in ADDED)])

            for i, value in enumerate(batch.column(text).to_pylist()):
                for entry in filed_under(value, threshold, as_longer):
                    rows.append(i)
                    for column, x in zip((keys, starts, chosen, rarest), entry):
                        column.append(x)
                    if len(rows) >= OUT_ROWS:
                        yield made()
                        rows, keys, starts, chosen, rarest = [], [], [], [], []
            if rows:
                yield made()

    schema = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, texts.schema.fields))
    added = f"key_{side} string, start_{side} int, chosen_{side} array<string>, rarest_{side} array<string>"
    return texts.mapInArrow(entries, f"{schema}, {added}")


def alike(parts: list[tuple[str, float]]) -> Column:
    """All parts similar enough, the parts being names of columns without their side."""
    return reduce(Column.__and__, [jaro_winkler(F.col(f"{c}_l"), F.col(f"{c}_r")) >= t for c, t in parts], F.lit(True))


def similar_texts(texts: DataFrame, scope: list[str], threshold: float, n: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(scope, text_l, text_r)``: different texts of a scope that reach the threshold, the longer one left, once each.

    ``texts`` holds ``n`` different rows of the scope's columns, ``text`` and its ``bag``. A key under which very many are filed is
    met in slices.
    """
    texts = texts.repartition(max(1, ceil(n / TASK_TEXTS)), *scope, "text")
    sides = [cut(_filed(texts, threshold, side == "l", side), f"filed-{side}") for side in "lr"]
    length = {side: F.length(f"text_{side}") for side in "lr"}
    p = F.col("start_l")
    ordered = F.struct(length["l"], F.col("text_l")) > F.struct(length["r"], F.col("text_r"))
    # The exact common beginning, and the first of the combinations two texts share: each pair is met once.
    begins = (p == PREFIX_MAX) | (p == length["r"]) | (
        F.substr("text_l", p + 1, F.lit(1)) != F.substr("text_r", p + 1, F.lit(1))
    )
    first = F.slice(F.array_intersect("rarest_l", "rarest_r"), F.lit(1), F.size("chosen_l")) == F.col("chosen_l")
    near = may_reach(threshold, "text_l", "text_r", "bag_l", "bag_r")
    met = sliced_join(
        *sides, [*(f"{c}_l" for c in scope), "key_l"], [*(f"{c}_r" for c in scope), "key_r"],
        ordered & near & ((F.col("key_l") == "long") | (begins & first)), slice_rows=slice_rows,
    )
    return met.where(alike([("text", threshold)])).select(*[F.col(f"{c}_l").alias(c) for c in scope], "text_l", "text_r")


def _measured(df: DataFrame, name: str, *sums: Column) -> tuple[DataFrame, list[float]]:
    """``df`` written, and sums or maxima over its rows."""
    seen, names = Observation(), [f"s{i}" for i in range(len(sums))]
    written = cut(df.observe(seen, *[F.coalesce(x.cast("double"), F.lit(0.0)).alias(n) for x, n in zip(sums, names)]), name)
    return written, observed(seen, written, *names)


def _meeting(texts: DataFrame, block: list[str], scope: list[str], threshold: float, n: float, slice_rows: int):
    """``(block, text, near, n_l, n_r)``: texts of a block that are equal or similar, with the numbers of their rows; what letting
    those meet costs; and the most rows a key of that join has on a side."""
    filed = texts.select(*scope, "text", "bag")
    pairs = similar_texts(filed if scope else filed.distinct(), scope, threshold, int(n), slice_rows)
    pairs = cut(pairs.select(*[F.col(c).alias(f"_in_{c}") for c in scope], F.col("text_l").alias("_text"), F.col("text_r").alias("near")), "similar")
    left = texts.select(*block, "text", F.col("n").alias("n_l"))
    right = texts.select(*[F.col(c).alias(f"_{c}") for c in block], F.col("text").alias("_near"), F.col("n").alias("n_r"))
    found = sliced_join(left, pairs, [*scope, "text"], [*(f"_in_{c}" for c in scope), "_text"], slice_rows=slice_rows)
    same = reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in block], F.col("near") == F.col("_near"))
    found = found.join(exchanged(right), same).select(*block, "text", "near", "n_l", "n_r")
    own = left.where("n_l > 1").select(*block, "text", F.col("text").alias("near"), "n_l", F.col("n_l").alias("n_r"))
    meeting, (rows, pairs) = _measured(found.unionByName(own), "meeting", F.sum("n_l"), F.sum(F.col("n_l").cast("double") * F.col("n_r")))
    sides = meeting.groupBy(*block, "near").agg(F.sum("n_l").alias("l"), F.max("n_r").alias("r"))
    _, (most,) = _measured(sides.select(F.greatest("l", "r").alias("most")), "most", F.max("most"))
    return meeting, MEETING * (rows + pairs), most, pairs


def _partitions(values: DataFrame, pairs: float) -> int | None:
    """For a join that makes so many pairs, or None where Spark's own number makes tasks small enough."""
    wanted = ceil(pairs / TASK_PAIRS)
    return wanted if wanted > int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def alike_values(values: DataFrame, block: list[str], parts: list[tuple[str, float]], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(value_l, value_r, n_l, n_r)``: pairs of rows of ``values`` in one block that are alike in all parts, once each, none with itself.

    ``values`` holds ``value`` (unique), ``n``, the block's columns and the parts' columns, all known, with a ``bag`` of each part.
    Rows meet by the similar texts of one part: that whose texts cost least to file, or another if filing that one as well costs less
    than letting the rows meet by the first. Texts are filed once for all blocks, or for each block where that leaves less to compare.
    """
    tried, waiting = [], []
    for c, t in parts:
        texts = values.groupBy(*block, F.col(c).alias("text"), F.col(f"bag{c}").alias("bag")).agg(F.count(F.lit(1)).alias("n"))
        texts = cut(texts, "texts")
        sizes = texts.groupBy(*block).agg(F.count(F.lit(1)).cast("double").alias("n"))
        _, (inside, squares) = _measured(sizes, "sizes", F.sum("n"), F.sum(F.col("n") * F.col("n")))
        in_all = texts.select("text").distinct().count()
        cost, scope, n = min((FILING * in_all + in_all**2, [], in_all), (FILING * inside + squares, block, inside))
        waiting.append((cost, c, t, texts, scope, n))
    waiting.sort(key=lambda w: w[:2])
    for _, c, t, texts, scope, n in waiting:
        meeting, cost, most, pairs = _meeting(texts, block, scope, t, n, slice_rows)
        tried.append((cost, c, meeting, most, pairs))
        if len(tried) == len(waiting) or waiting[len(tried)][0] >= min(tried, key=lambda x: x[:2])[0]:
            break
    _, lead, meeting, most, pairs = min(tried, key=lambda x: x[:2])
    others = [(c, t) for c, t in parts if c != lead]
    about = ["value", "n", *[name for c, _ in others for name in (c, f"bag{c}")]]
    sides = {side: values.select(
        *[F.col(c).alias(f"{c}_{side}") for c in block], F.col(lead).alias(f"text_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in about]
    ) for side in "lr"}
    here = reduce(Column.__and__, [F.col(f"{c}_l") == F.col(c) for c in block], F.col("text_l") == F.col("text"))
    left = sides["l"].join(exchanged(meeting.select(*block, "text", "near")), here).select(*sides["l"].columns, "near")
    if most > slice_rows:
        left = cut(left, "near")
    once = (F.col("text_l") != F.col("near")) | (F.col("value_l") > F.col("value_r"))
    reach = [may_reach(t, f"{c}_l", f"{c}_r", f"bag{c}_l", f"bag{c}_r") for c, t in others]
    met = sliced_join(
        left, sides["r"], [*(f"{c}_l" for c in block), "near"], [*(f"{c}_r" for c in block), "text_r"], reduce(Column.__and__, reach, once),
        slice_rows=slice_rows if most > slice_rows else None, partitions=_partitions(values, pairs),
    )
    return met.where(alike(others)).select("value_l", "value_r", "n_l", "n_r")


def alike_pairs(records: DataFrame, rule: tuple[str, ...], parts: list[Part], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All pairs of records that agree on the rule and are at least so similar in every part, smaller id left.

    The result is that of ``blocking.rule_pairs`` filtered by ``jaro_winkler(part_l, part_r) >= threshold``. Thresholds lie above
    0.7. A record without a value in the rule or a part meets nobody; equal texts are alike, empty ones too. Different
    records of equal rule values and parts are one value while values are compared.
    """
    if any(t <= BOOST_ABOVE for _, t in parts):
        raise ValueError(f"thresholds must lie above {BOOST_ABOVE}")
    named = [(f"_part{i}", t) for i, (_, t) in enumerate(parts)]
    columns, block = records.columns, [f"_block{i}" for i in range(len(rule))]
    by = [*block, *(n for n, _ in named)]
    known = records.select(
        "*", *[F.col(c).alias(b) for c, b in zip(rule, block)], *[expr.alias(n) for (expr, _), (n, _) in zip(parts, named)]
    ).dropna(subset=by)
    values = cut(known.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(
        F.monotonically_increasing_id().alias("value"), *by, *[bag(c).alias(f"bag{c}") for c, _ in named], "n"
    ), "values")
    met = alike_values(values, block, named, slice_rows)
    one, other = (F.struct(*[F.col(f"{c}_{x}").alias(f"{c}_{as_}") for x, as_ in (("l", "a"), ("r", "b")) for c in ("value", "n")]),
                  F.struct(*[F.col(f"{c}_{x}").alias(f"{c}_{as_}") for x, as_ in (("r", "a"), ("l", "b")) for c in ("value", "n")]))
    both = met.select(F.explode(F.array(one, other)).alias("m")).select("m.*")
    own = values.where("n > 1").select(*[F.col(c).alias(f"{c}_{x}") for x in "ab" for c in ("value", "n")])
    both, (pairs,) = _measured(both.unionByName(own), "alike", F.sum(F.col("n_a").cast("double") * F.col("n_b")))
    _, (most,) = _measured(both.groupBy("value_b").agg(F.sum("n_a").alias("most")).select("most"), "most", F.max("most"))
    members = cut(known.join(exchanged(values.select("value", *by)), by).select(*columns, "value"), "members")
    left, right = (members.select(*[F.col(c).alias(f"{c}_{side}") for c in members.columns]) for side in "lr")
    out = [f"{c}_{side}" for side in "lr" for c in columns]
    # No value has more members, or more partners, than its partners have members in all.
    sliced = slice_rows if most > slice_rows else None
    partners = sliced_join(left, both.select("value_a", "value_b"), ["value_l"], ["value_a"], slice_rows=sliced)
    if sliced:
        partners = cut(partners, "partners")
    return sliced_join(
        partners, right, ["value_b"], ["value_r"], F.col("record_id_l") < F.col("record_id_r"), slice_rows=sliced,
        partitions=_partitions(values, pairs),
    ).select(*out)
