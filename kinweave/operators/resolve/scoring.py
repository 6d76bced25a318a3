"""Scored pairs, without making the pairs that cannot reach the threshold.

The result is exactly that of scoring every candidate pair and keeping those at or above the threshold.
Two bounds that follow from the model's weights leave pairs out beforehand:

* a record that would stay below the threshold even if all its known fields agreed with another record
  is in no result;
* in a blocking value shared by very many records, every pair that reaches the threshold must agree on
  something besides that value, or be similar in it. What it is follows from the level combinations that reach
  the threshold, and the block is joined on that as well instead of with itself.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.operators.resolve.alike import alike_pairs
from kinweave.operators.resolve.blocking import BLOCKING_RULES, agree, candidate_pairs, rule_name, rule_pairs
from kinweave.operators.resolve.comparisons import Comparison, with_gammas, with_term_frequencies
from kinweave.operators.resolve.model import MatchModel, level_bits, prior_bits, tf_columns, with_weights
from kinweave.operators.skew import BROADCAST_ROWS, SLICE_ROWS, hot_keys
from kinweave.session import cut

# Room for rounding when a bound is compared with the threshold.
SLACK = 1e-6


def _threshold_bits(threshold: float) -> float:
    return math.log2(threshold / (1 - threshold)) - SLACK


def _fixed_by(rule: tuple[str, ...], comparison: Comparison) -> bool:
    """Whether agreeing on the rule puts the comparison on its closest level."""
    return set(comparison.columns) <= set(rule)


def best_case(model: MatchModel, rule: tuple[str, ...]) -> Column:
    """The most bits a record can reach with any record it meets under the rule."""
    total = F.lit(prior_bits(model))
    for c in model.comparisons:
        top = level_bits(model, c.name, c.top)
        others = [level_bits(model, c.name, level) for level in range(c.top)]
        closest = F.lit(top)
        if c.term_frequency:
            closest = closest + F.log2(F.lit(model.u[c.name][c.top]) / F.col(f"tf_{c.columns[0]}"))
        # A partner without a value is worth nothing, which is best if every level counts against a match.
        best = closest if _fixed_by(rule, c) else F.greatest(closest, F.lit(max(others)), F.lit(0.0))
        missing = reduce(Column.__or__, [F.col(column).isNull() for column in c.columns])
        total = total + F.when(missing, F.lit(0.0)).otherwise(best)
    return total


def refinements(
    model: MatchModel, rule: tuple[str, ...], threshold: float, least_tf: float, similar: bool = False
) -> list[tuple[Comparison, int]] | None:
    """Levels of which every pair reaching the threshold under the rule has at least one.

    ``least_tf`` bounds from below the frequency of the blocking value. None if some combination of levels
    reaches the threshold although it makes nothing but the blocking value equal. With ``similar``, a combination that
    makes nothing equal may make something similar instead.
    """
    options = []
    for c in model.comparisons:
        levels = [c.top] if _fixed_by(rule, c) else range(-1, c.top + 1)
        choices = []
        for level in levels:
            bits = 0.0 if level < 0 else level_bits(model, c.name, level)
            if c.term_frequency and level == c.top:
                # An agreement outside the rule can be arbitrarily rare, but it is an equality.
                bits = bits + math.log2(model.u[c.name][level] / least_tf) if _fixed_by(rule, c) else math.inf
            equal = level > 0 and not _fixed_by(rule, c) and bool(c.shared()[c.top - level])
            # Sharing only columns of the rule refines nothing.
            if equal and len(c.columns) > 1:
                equal = not _only_rule_columns(c, level, rule)
            close = similar and not _fixed_by(rule, c) and _similar_parts(c, level)
            choices.append((bits, (c.name, level) if equal else None, (c.name, level) if close else None))
        options.append(choices)
    reaching = []
    for combination in itertools.product(*options):
        if prior_bits(model) + sum(bits for bits, _, _ in combination) >= _threshold_bits(threshold):
            needed = {key for _, key, _ in combination if key} or {key for _, _, key in combination if key}
            if not needed:
                return None
            reaching.append(needed)
    chosen: list[tuple[str, int]] = []
    while reaching:
        counts = {key: sum(key in equal for equal in reaching) for equal in reaching for key in equal}
        key = max(counts, key=lambda k: (counts[k], k))
        chosen.append(key)
        reaching = [equal for equal in reaching if key not in equal]
    by_name = {c.name: c for c in model.comparisons}
    keys = [(by_name[name], level) for name, level in chosen]
    return sorted(keys, key=lambda k: bool(_similar_parts(*k)))


def _similar_parts(comparison: Comparison, level: int) -> tuple[tuple[Column, float], ...]:
    return comparison.similar()[comparison.top - level] if comparison.similar and level > 0 else ()


def _only_rule_columns(comparison: Comparison, level: int, rule: tuple[str, ...]) -> bool:
    shared = {str(expr) for expr in comparison.shared()[comparison.top - level]}
    return shared <= {str(F.col(column)) for column in rule}


def _refined_pairs(
    records: DataFrame, rule: tuple[str, ...], keys: list[tuple[Comparison, int]], slice_rows: int
) -> DataFrame:
    """Pairs that agree on the rule and are equal or similar in at least one of the keys, each once."""
    columns, names = records.columns, []
    for i, (c, level) in enumerate(keys):
        parts = c.shared()[c.top - level]
        names.append(tuple(f"_also{i}_{j}" for j in range(len(parts))))
        records = records.select("*", *[part.alias(name) for part, name in zip(parts, names[-1])])
    found, earlier = [], []
    for (c, level), also in zip(keys, names):
        if also:
            pairs, met = rule_pairs(records, (*rule, *also), slice_rows), agree(also)
        else:
            pairs, met = alike_pairs(records, rule, list(_similar_parts(c, level)), slice_rows), c.conditions()[c.top - level]
        for before in earlier:
            pairs = pairs.where(~F.coalesce(before, F.lit(False)))
        earlier.append(met)
        found.append(pairs)
    return reduce(DataFrame.unionByName, found).select(*[f"{c}_{side}" for side in "lr" for c in columns])


def promising_pairs(
    known: DataFrame, rule: tuple[str, ...], model: MatchModel, threshold: float, records_in_all: int, slice_rows: int
) -> DataFrame:
    """The rule's pairs without those that a bound shows to stay below the threshold."""
    able = known.where(best_case(model, rule) >= _threshold_bits(threshold))
    hot, n_hot = hot_keys(able, list(rule), slice_rows)
    if n_hot == 0:
        return rule_pairs(able, rule, None)
    keys = refinements(model, rule, threshold, slice_rows / records_in_all, similar=True)
    if keys is None:
        return rule_pairs(able, rule, slice_rows)
    if n_hot <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    cold = rule_pairs(able.dropna(subset=list(rule)).join(hot, list(rule), "left_anti"), rule, None)
    if not keys:
        return cold
    inside = able.join(hot, list(rule), "left_semi")
    return cold.unionByName(_refined_pairs(inside, rule, keys, slice_rows))


def score_pairs(
    records: DataFrame, model: MatchModel, rules: list[tuple[str, ...]] | None = None,
    threshold: float | None = 0.8, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Candidate pairs with levels, weights and probability, those at or above ``threshold``."""
    known = cut(with_term_frequencies(records, model.comparisons), "known")
    return score_known_pairs(known, model, rules, threshold, slice_rows, records)


def score_known_pairs(
    known: DataFrame, model: MatchModel, rules: list[tuple[str, ...]] | None, threshold: float | None,
    slice_rows: int, counted_in: DataFrame,
) -> DataFrame:
    """``score_pairs`` of records that already carry their term frequencies, counted in ``counted_in``."""
    rules = rules or BLOCKING_RULES
    if threshold is None:
        pairs = candidate_pairs(known, rules, slice_rows)
    else:
        n = max(1, counted_in.count())
        parts = []
        for i, rule in enumerate(rules):
            part = promising_pairs(known, rule, model, threshold, n, slice_rows)
            for earlier in rules[:i]:
                part = part.where(~F.coalesce(agree(earlier), F.lit(False)))
            parts.append(part.withColumn("match_key", F.lit(rule_name(rule))))
        pairs = reduce(DataFrame.unionByName, parts)
    tf = [F.col(f"{c}_l").alias(c) for c in tf_columns(model)]
    gammas = with_gammas(pairs.select("*", *tf), model.comparisons, ("match_key", *tf_columns(model)))
    scored = with_weights(gammas, model)
    return scored if threshold is None else scored.where(F.col("match_probability") >= threshold)
