"""Match model: level probabilities, training and scoring."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, functions as F

from kinweave.functions.buckets import stable_bucket
from kinweave.operators.resolve.blocking import count_rule_pairs, rule_name, rule_pairs
from kinweave.operators.resolve.comparisons import (
    Comparison, guest_comparisons, level_counts, pattern_counts, with_gammas,
)
from kinweave.operators.skew import BROADCAST_ROWS, SLICE_ROWS
from kinweave.session import cut, exchanged, observed

FLOOR = 1e-6
# Random pairs that one task compares.
PAIRS_PER_TASK = 50_000


@dataclass(frozen=True)
class MatchModel:
    """Probability that two random records match, and per comparison the probability of each level
    (index 0 = "all other") among matches (``m``) and among non-matches (``u``)."""

    prior: float
    m: dict[str, list[float]]
    u: dict[str, list[float]]
    comparisons: list[Comparison] = field(default_factory=guest_comparisons)


# A hand-set model for the guest comparisons, for use without training.
GIVEN_MODEL = MatchModel(
    prior=0.0004,
    m={
        "name": [0.05, 0.04, 0.08, 0.06, 0.12, 0.01, 0.64],
        "email": [0.08, 0.04, 0.33, 0.05, 0.5],
        "postcode": [0.02, 0.01, 0.01, 0.96],
        "phone": [0.03, 0.97],
        "dob": [0.02, 0.98],
    },
    u={
        "name": [0.892, 0.045, 0.05, 0.004, 0.005, 0.001, 0.003],
        "email": [0.55, 0.01, 0.4, 0.0395, 0.0005],
        "postcode": [0.74, 0.17, 0.07, 0.02],
        "phone": [0.999, 0.001],
        "dob": [0.998, 0.002],
    },
)


def estimate_prior(records: DataFrame, rules: list[tuple[str, ...]] | None = None, recall: float = 0.7) -> DataFrame:
    """One row: pairs found by deterministic rules, scaled by their recall, as a share of all pairs."""
    n = F.col("records").cast("double")
    return count_rule_pairs(records, rules).select(
        F.col("pairs").cast("long").alias("rule_pairs"), "records",
        F.when(n > 1, F.col("pairs") / F.lit(recall) / (n * (n - 1) / 2)).alias("prior"),
    )


def sample_random_pairs(
    records: DataFrame, max_pairs: int = 1_000_000, slice_rows: int | None = None
) -> DataFrame:
    """About ``max_pairs`` pairs drawn evenly from all pairs, or all of them if there are fewer.

    Records fall into hash buckets, and records of one bucket are paired. The number of buckets grows
    with the square of the records, so the sample is one equi-join whose size stays the same. Only ids are
    joined; the fields are then fetched for the ids drawn, at most two for each pair. The buckets are even, being
    hashes of ids, so none needs slicing unless ``slice_rows`` says so.
    """
    n = records.count()
    all_pairs = n * (n - 1) / 2
    drawn = records.select("record_id", stable_bucket_wide("record_id", max(1, math.ceil(all_pairs / max_pairs))).alias("bucket"))
    ids = cut(rule_pairs(drawn, ("bucket",), slice_rows).select("record_id_l", "record_id_r"), "drawn-pairs")
    seen = Observation()
    wanted = cut(
        ids.select(F.explode(F.array("record_id_l", "record_id_r")).alias("record_id")).distinct().observe(seen, F.count(F.lit(1)).alias("n")),
        "drawn-ids",
    )
    # Few enough ids go to the records; more of them meet the records in a shuffle.
    few = observed(seen, wanted, "n")[0] <= BROADCAST_ROWS
    found = cut(records.join(F.broadcast(wanted) if few else wanted, "record_id", "left_semi"), "drawn-records")
    for side in "lr":
        ids = ids.join(exchanged(found.select(*[F.col(c).alias(f"{c}_{side}") for c in records.columns])), f"record_id_{side}")
    return ids.repartition(max(1, math.ceil(min(all_pairs, max_pairs) / PAIRS_PER_TASK)))


def stable_bucket_wide(column: str, buckets: int) -> Column:
    """Like ``stable_bucket`` by md5, from 60 bits, for more buckets than 32 bits can tell apart."""
    return F.conv(F.substring(F.md5(F.col(column)), 1, 15), 16, 10).cast("long") % F.lit(buckets).cast("long")


def estimate_u(records: DataFrame, comparisons: list[Comparison], max_pairs: int = 1_000_000) -> DataFrame:
    """``(comparison, level, pairs, u_prob)``: level shares among random pairs."""
    gammas = with_gammas(sample_random_pairs(records, max_pairs), comparisons)
    counts = level_counts(pattern_counts(gammas, comparisons), comparisons)
    total = counts.groupBy("comparison").agg(F.sum("pairs").alias("known"))
    return counts.join(total, "comparison").select(
        "comparison", "level", "pairs", (F.col("pairs") / F.col("known")).alias("u_prob")
    )


def rule_patterns(
    records: DataFrame, rule: tuple[str, ...], comparisons: list[Comparison], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Pairs that agree on the rule, per combination of levels.

    Records alike in all columns that matter are counted first, so copies are multiplied, not paired.
    """
    columns = sorted({*rule, *(column for c in comparisons for column in c.columns)})
    kinds = cut(
        records.dropna(subset=list(rule)).groupBy(*columns)
        .agg(F.min("record_id").alias("record_id"), F.count(F.lit(1)).cast("double").alias("copies")),
        "kinds",
    )
    apart = rule_pairs(kinds, rule, slice_rows).withColumn("pairs", F.col("copies_l") * F.col("copies_r"))
    alike = kinds.where(F.col("copies") > 1).select(
        *[F.col(c).alias(f"{c}_{side}") for side in "lr" for c in kinds.columns],
        (F.col("copies") * (F.col("copies") - 1) / 2).alias("pairs"),
    )
    counted = with_gammas(apart.unionByName(alike), comparisons, ("pairs",))
    return counted.groupBy(*[f"gamma_{c.name}" for c in comparisons]).agg(F.sum("pairs").alias("pairs"))


def starting_m(top: int) -> list[float]:
    """Most of the matches on the closest level, the rest spread evenly."""
    return [0.1 / top] * top + [0.9]


def em_session(
    patterns: list, comparisons: list[Comparison], u: dict[str, list[float]], rounds: int = 25, share: float = 0.5
) -> tuple[float, dict[str, list[float]]]:
    """Fit the match share and ``m`` to pattern counts with ``u`` held fixed.

    ``patterns`` are the rows of ``pattern_counts``, whose number is bounded by the level counts.
    """
    gamma = {c.name: np.array([row[f"gamma_{c.name}"] for row in patterns]) for c in comparisons}
    weight = np.array([row["pairs"] for row in patterns], dtype=float)
    m = {c.name: np.array(starting_m(c.top)) for c in comparisons}

    def likelihood(probs):
        out = np.ones(len(weight))
        for c in comparisons:
            g = gamma[c.name]
            out *= np.where(g < 0, 1.0, np.asarray(probs[c.name])[np.maximum(g, 0)])
        return out

    from_u = likelihood(u)
    for _ in range(rounds):
        hit = share * likelihood(m)
        expected = weight * hit / (hit + (1 - share) * from_u)
        share = float(np.clip(expected.sum() / weight.sum(), FLOOR, 1 - FLOOR))
        for c in comparisons:
            g = gamma[c.name]
            mass = np.array([expected[g == level].sum() for level in range(c.top + 1)])
            if mass.sum() > 0:
                m[c.name] = np.clip(mass / mass.sum(), FLOOR, 1 - FLOOR)
    return share, {name: probs.tolist() for name, probs in m.items()}


@dataclass(frozen=True)
class Training:
    model: MatchModel
    sessions: dict[str, tuple[float, dict[str, list[float]]]]

    def rows(self) -> list[tuple[str, str, int, float, float]]:
        """``(session, comparison, level, m, u)`` per session and, as session ``model``, their averages."""
        fitted = {name: m for name, (_, m) in self.sessions.items()} | {"model": self.model.m}
        return [
            (session, name, level, float(p), float(self.model.u[name][level]))
            for session, by_name in fitted.items() for name, probs in by_name.items() for level, p in enumerate(probs)
        ]


def train(
    records: DataFrame,
    comparisons: list[Comparison] | None = None,
    prior_rules: list[tuple[str, ...]] | None = None,
    training_rules: tuple[tuple[str, ...], ...] = (("email",), ("postcode", "last_name")),
    recall: float = 0.7,
    max_pairs: int = 1_000_000,
    rounds: int = 25,
    slice_rows: int = SLICE_ROWS,
    levels: DataFrame | None = None,
) -> Training:
    """Estimate prior, ``u`` and ``m``; a session per training rule leaves out the comparisons that use its
    columns, and each comparison's ``m`` is averaged over the sessions that could fit it. ``levels`` are the rows of
    ``estimate_u`` where they are known already."""
    comparisons = comparisons or guest_comparisons()
    prior = estimate_prior(records, prior_rules, recall).first()["prior"]
    u = {c.name: [FLOOR] * (c.top + 1) for c in comparisons}
    # At most one row per comparison and level.
    for row in (estimate_u(records, comparisons, max_pairs) if levels is None else levels).collect():
        u[row["comparison"]][row["level"]] = min(max(row["u_prob"], FLOOR), 1 - FLOOR)

    sessions = {}
    for rule in training_rules:
        free = [c for c in comparisons if not set(c.columns) & set(rule)]
        # At most the product of the level counts.
        patterns = rule_patterns(records, rule, free, slice_rows).collect()
        if patterns:
            sessions[rule_name(rule)] = em_session(patterns, free, u, rounds)

    m = {}
    for c in comparisons:
        fitted = [by_name[c.name] for _, by_name in sessions.values() if c.name in by_name]
        m[c.name] = np.mean(fitted, axis=0).tolist() if fitted else starting_m(c.top)
    model = MatchModel(min(max(prior or FLOOR, FLOOR), 1 - FLOOR), m, u, comparisons)
    return Training(model, sessions)


def level_bits(model: MatchModel, name: str, level: int) -> float:
    """Weight of a level, rarity left out."""
    return math.log2(model.m[name][level] / model.u[name][level])


def prior_bits(model: MatchModel) -> float:
    return math.log2(model.prior / (1 - model.prior))


def with_weights(gammas: DataFrame, model: MatchModel) -> DataFrame:
    """Add per comparison the weight ``bf_<name>`` in bits and ``bf_tf_<name>`` where rarity counts, then
    ``match_weight`` and ``match_probability``. The level weights are constants of the plan."""
    weights: list[Column] = []
    columns: list[Column] = []
    for c in model.comparisons:
        gamma = F.col(f"gamma_{c.name}")
        bits = F.lit(0.0)
        for level in range(c.top + 1):
            bits = F.when(gamma == level, F.lit(level_bits(model, c.name, level))).otherwise(bits)
        columns.append(bits.alias(f"bf_{c.name}"))
        weights.append(F.col(f"bf_{c.name}"))
        if c.term_frequency:
            rarity = F.log2(F.lit(model.u[c.name][c.top]) / F.col(f"tf_{c.columns[0]}"))
            columns.append(F.when(gamma == c.top, rarity).otherwise(F.lit(0.0)).alias(f"bf_tf_{c.name}"))
            weights.append(F.col(f"bf_tf_{c.name}"))
    total = F.lit(prior_bits(model))
    for w in weights:
        total = total + w
    return (
        gammas.select("*", *columns).withColumn("match_weight", total)
        .withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))
    )


def tf_columns(model: MatchModel) -> list[str]:
    return [f"tf_{c.columns[0]}" for c in model.comparisons if c.term_frequency]


def explain(scored: DataFrame, model: MatchModel) -> DataFrame:
    """One row per pair and comparison: the level reached and the bits it adds, rarity included."""
    rows = [
        F.struct(
            F.lit(c.name).alias("comparison"), F.col(f"gamma_{c.name}").alias("level"),
            (F.col(f"bf_{c.name}") + (F.col(f"bf_tf_{c.name}") if c.term_frequency else F.lit(0.0))).alias("bits"),
        )
        for c in model.comparisons
    ]
    return scored.select("record_id_l", "record_id_r", F.explode(F.array(*rows)).alias("e")).select(
        "record_id_l", "record_id_r", "e.*"
    )
