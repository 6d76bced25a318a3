"""Candidate pairs: records that agree on at least one blocking rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.operators.skew import SLICE_ROWS, sliced_join

# The fields compared and the blocking rules, in order.
FIELDS = ["first_name", "last_name", "email", "phone", "postcode", "dob"]
BLOCKING_RULES: list[tuple[str, ...]] = [("email",), ("postcode", "last_name"), ("phone",)]


def rule_name(rule: tuple[str, ...]) -> str:
    return "+".join(rule)


def comparison_input(guests_raw: DataFrame) -> DataFrame:
    """The id and the compared fields; the truth column stays behind."""
    return guests_raw.select("record_id", *FIELDS)


def agree(rule: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(f"{c}_l") == F.col(f"{c}_r") for c in rule])


def rule_pairs(records: DataFrame, rule: tuple[str, ...], slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """All pairs that agree on one rule, smaller id left. Nulls agree with nothing."""
    left, right = (records.select(*[F.col(c).alias(f"{c}_{side}") for c in records.columns]) for side in "lr")
    return sliced_join(
        left.dropna(subset=[f"{c}_l" for c in rule]), right.dropna(subset=[f"{c}_r" for c in rule]),
        [f"{c}_l" for c in rule], [f"{c}_r" for c in rule],
        F.col("record_id_l") < F.col("record_id_r"), same_counts=True, slice_rows=slice_rows,
    )


def candidate_pairs(
    records: DataFrame, rules: list[tuple[str, ...]] | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every pair that agrees on some rule, once, with both sides' columns and the first rule it meets.

    One equi-join per rule. A pair that an earlier rule has found is recognised from its own columns, so
    no shuffle is spent on removing duplicates.
    """
    rules = rules or BLOCKING_RULES
    parts = []
    for i, rule in enumerate(rules):
        pairs = rule_pairs(records, rule, slice_rows)
        for earlier in rules[:i]:
            pairs = pairs.where(~F.coalesce(agree(earlier), F.lit(False)))
        parts.append(pairs.withColumn("match_key", F.lit(rule_name(rule))))
    return reduce(DataFrame.unionByName, parts)


def block_sizes(records: DataFrame, rule: tuple[str, ...], at_least: int = 2) -> DataFrame:
    """Records per blocking value, for finding the values that cost most."""
    return (
        records.dropna(subset=list(rule)).groupBy(*rule).agg(F.count(F.lit(1)).alias("records"))
        .where(F.col("records") >= at_least)
    )


def count_rule_pairs(records: DataFrame, rules: list[tuple[str, ...]] | None = None) -> DataFrame:
    """One row ``(pairs, records)``: pairs that agree on some rule, counted without making them.

    A group of n records holds n(n-1)/2 pairs. Pairs meeting several rules are corrected by
    inclusion-exclusion over the combinations of rules, all grouped in one pass.
    """
    rules = rules or BLOCKING_RULES
    columns = sorted({c for rule in rules for c in rule})
    grouped = {}
    for mask in range(1, 2 ** len(rules)):
        chosen = [rule for i, rule in enumerate(rules) if mask >> i & 1]
        key = tuple(sorted({c for rule in chosen for c in rule}))
        grouped[key] = grouped.get(key, 0) + (1 if len(chosen) % 2 else -1)
    # Bit i (from the left) of grouping_id is set where column i is not part of the group.
    ids = {key: int("".join("0" if c in key else "1" for c in columns), 2) for key in grouped}
    n = F.col("n").cast("decimal(38,0)")
    counted = records.groupingSets([[F.col(c) for c in key] for key in grouped], *columns).agg(
        F.grouping_id(*columns).alias("gid"), F.count(F.lit(1)).alias("n")
    )
    signed = F.lit(None).cast("decimal(38,0)")
    for key, sign in grouped.items():
        whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
        signed = F.when((F.col("gid") == ids[key]) & whole, n * (n - 1) * sign).otherwise(signed)
    pairs = counted.agg((F.sum(signed) / 2).cast("double").alias("pairs"))
    return pairs.select(
        F.coalesce("pairs", F.lit(0.0)).alias("pairs"),
        records.agg(F.count(F.lit(1)).alias("records")).scalar().alias("records"),
    )
