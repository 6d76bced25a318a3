"""Graded comparisons of a candidate pair.

Each comparison maps a pair to a level: 0 is "all other", higher is closer, -1 means a side is missing
and the pair gives no evidence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.functions.similarity import jaro_winkler
from kinweave.session import cut, exchanged


@dataclass(frozen=True)
class Comparison:
    """``levels`` are named from the closest down and leave out the null and the last, "all other" level.

    ``shared`` gives for each of these levels what two records at that level have in common, as
    expressions over one record that are equal on both sides; empty where nothing need be equal. ``similar`` gives
    expressions whose Jaro-Winkler similarity is at least the number beside them, where nothing need be equal.
    """

    name: str
    columns: tuple[str, ...]
    levels: tuple[str, ...]
    conditions: Callable[[], list[Column]]
    shared: Callable[[], list[tuple[Column, ...]]]
    term_frequency: bool = False
    similar: Callable[[], list[tuple[tuple[Column, float], ...]]] | None = None

    @property
    def top(self) -> int:
        return len(self.levels)

    def gamma(self) -> Column:
        out = F.lit(0)
        for i, condition in reversed(list(enumerate(self.conditions()))):
            out = F.when(condition, F.lit(self.top - i)).otherwise(out)
        missing = [F.col(f"{c}_{side}").isNull() for c in self.columns for side in "lr"]
        return F.when(reduce(Column.__or__, missing), F.lit(-1)).otherwise(out).cast("int")


def _sides(column: str) -> tuple[Column, Column]:
    return F.col(f"{column}_l"), F.col(f"{column}_r")


def forename_surname(first: str, last: str, close: tuple[float, ...] = (0.92, 0.88)) -> Comparison:
    """One joint comparison of two name columns."""

    def conditions() -> list[Column]:
        (fl, fr), (ll, lr) = _sides(first), _sides(last)
        first_sim, last_sim = jaro_winkler(fl, fr), jaro_winkler(ll, lr)
        return [
            (fl == fr) & (ll == lr),
            (fl == lr) & (ll == fr),
            *[(first_sim >= t) & (last_sim >= t) for t in close],
            ll == lr,
            fl == fr,
        ]

    def shared() -> list[tuple[Column, ...]]:
        f, l = F.col(first), F.col(last)
        return [(f, l), (F.least(f, l), F.greatest(f, l)), *[() for _ in close], (l,), (f,)]

    def similar() -> list[tuple[tuple[Column, float], ...]]:
        return [(), (), *[((F.col(first), t), (F.col(last), t)) for t in close], (), ()]

    names = ("both exact", "swapped", *[f"both similar {t}" for t in close], "surname exact", "forename exact")
    return Comparison("name", (first, last), names, conditions, shared, similar=similar)


def email(column: str, close: float = 0.88) -> Comparison:
    def conditions() -> list[Column]:
        a, b = _sides(column)
        user_a, user_b = F.substring_index(a, "@", 1), F.substring_index(b, "@", 1)
        return [a == b, user_a == user_b, jaro_winkler(a, b) >= close, jaro_winkler(user_a, user_b) >= close]

    def shared() -> list[tuple[Column, ...]]:
        return [(F.col(column),), (F.substring_index(F.col(column), "@", 1),), (), ()]

    def similar() -> list[tuple[tuple[Column, float], ...]]:
        whole = F.col(column)
        return [(), (), ((whole, close),), ((F.substring_index(whole, "@", 1), close),)]

    levels = ("exact", "same user", f"similar {close}", f"similar user {close}")
    return Comparison(column, (column,), levels, conditions, shared, similar=similar)


def postcode(column: str, graded: bool = True) -> Comparison:
    """Graded by district and area, or plain equality when not ``graded``."""
    if not graded:
        return exact(column)

    def district(c: Column) -> Column:
        return F.substring_index(c, " ", 1)

    def area(c: Column) -> Column:
        return F.nullif(F.regexp_extract(c, "^[A-Za-z]+", 0), F.lit(""))

    def conditions() -> list[Column]:
        a, b = _sides(column)
        return [a == b, district(a) == district(b), area(a) == area(b)]

    def shared() -> list[tuple[Column, ...]]:
        c = F.col(column)
        return [(c,), (district(c),), (area(c),)]

    return Comparison(column, (column,), ("exact", "same district", "same area"), conditions, shared)


def exact(column: str, term_frequency: bool = False) -> Comparison:
    def conditions() -> list[Column]:
        a, b = _sides(column)
        return [a == b]

    def shared() -> list[tuple[Column, ...]]:
        return [(F.col(column),)]

    return Comparison(column, (column,), ("exact",), conditions, shared, term_frequency)


def guest_comparisons(graded_postcode: bool = True) -> list[Comparison]:
    return [
        forename_surname("first_name", "last_name"),
        email("email"),
        postcode("postcode", graded_postcode),
        exact("phone", term_frequency=True),
        exact("dob"),
    ]


def with_gammas(pairs: DataFrame, comparisons: list[Comparison], keep: tuple[str, ...] = ()) -> DataFrame:
    """The pair's ids, the columns in ``keep`` and one ``gamma_<comparison>`` per comparison."""
    return pairs.select(
        "record_id_l", "record_id_r", *keep, *[c.gamma().alias(f"gamma_{c.name}") for c in comparisons]
    )


def pattern_counts(gammas: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    """Pairs per combination of levels: at most the product of the level counts, whatever the data size."""
    return gammas.groupBy(*[f"gamma_{c.name}" for c in comparisons]).agg(F.count(F.lit(1)).alias("pairs"))


def level_counts(patterns: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    """``(comparison, level, pairs)`` summed from pattern counts; missing values are left out."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("comparison"), F.col(f"gamma_{c.name}").alias("level")) for c in comparisons
    ]))
    return (
        patterns.select(rows.alias("e"), "pairs").where(F.col("e.level") >= 0)
        .groupBy("e.comparison", "e.level").agg(F.sum("pairs").alias("pairs"))
    )


def term_frequencies(records: DataFrame, column: str) -> DataFrame:
    """Share of each value among the records that have one."""
    known = records.dropna(subset=[column])
    total = known.agg(F.count(F.lit(1)))
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("n")).select(
        column, (F.col("n") / total.scalar()).alias(f"tf_{column}")
    )


def with_term_frequencies(records: DataFrame, comparisons: list[Comparison], of: DataFrame | None = None) -> DataFrame:
    """Add ``tf_<column>`` for the comparisons that weigh agreement by rarity, counted over ``of``."""
    for c in comparisons:
        if c.term_frequency:
            column = c.columns[0]
            # Rows without a value match nothing; the second key keeps them from meeting in one task.
            lone = F.when(F.col(column).isNull(), F.pmod(F.xxhash64("record_id"), F.lit(4096))).otherwise(0)
            freq = exchanged(cut(term_frequencies(records if of is None else of, column), "frequencies"))
            freq = freq.withColumn("_lone", F.lit(0).cast("long"))
            records = records.withColumn("_lone", lone.cast("long")).join(freq, [column, "_lone"], "left").drop("_lone")
    return records
