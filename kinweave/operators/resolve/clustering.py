"""From scored pairs to golden ids, and how good they are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.operators.components import connected_components
from kinweave.operators.resolve.blocking import BLOCKING_RULES, FIELDS
from kinweave.operators.resolve.comparisons import with_gammas, with_term_frequencies
from kinweave.operators.resolve.model import MatchModel, tf_columns, with_weights
from kinweave.operators.resolve.scoring import score_known_pairs
from kinweave.operators.skew import SLICE_ROWS
from kinweave.session import cut, discarded, exchanged


def cluster_pairs(records: DataFrame, scored: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(record_id, golden_id)`` for every record: components of the pairs at or above ``threshold``.

    The golden id is the smallest record id; a record without links is its own golden guest.
    """
    links = scored.where(F.col("match_probability") >= threshold).select(
        F.col("record_id_l").alias("src"), F.col("record_id_r").alias("dst")
    )
    found = connected_components(records.select(F.col("record_id").alias("id")), links)
    return found.select(F.col("id").alias("record_id"), F.col("component").alias("golden_id"))


def resolve(
    records: DataFrame, model: MatchModel, rules: list[tuple[str, ...]] | None = None,
    threshold: float = 0.9, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The same map as ``cluster_pairs`` over all scored pairs, pairing each distinct content only once.

    Records that agree in every compared field form one profile, named by its smallest record id, so a
    group of copies costs one row however large it is. Copies belong together if a profile's score against itself
    reaches the threshold, or if the profile is linked to another one, which links each of its copies.
    """
    rules = rules or BLOCKING_RULES
    # Only the map from content to golden id is read by the result; what led to it goes.
    with discarded(records.sparkSession):
        profiles = cut(
            records.groupBy(*FIELDS).agg(F.min("record_id").alias("record_id"), F.count(F.lit(1)).alias("copies")),
            "profiles",
        )
        known = cut(with_term_frequencies(profiles, model.comparisons, records), "known")
        links = cut(
            score_known_pairs(known.drop("copies"), model, rules, threshold, slice_rows, records).select(
                F.col("record_id_l").alias("src"), F.col("record_id_r").alias("dst")
            ),
            "links",
        )
        blocked = reduce(
            Column.__or__, [reduce(Column.__and__, [F.col(f"{c}_l").isNotNull() for c in rule]) for rule in rules]
        )
        twins = known.where(F.col("copies") > 1).select(
            *[F.col(c).alias(f"{c}_{side}") for side in "lr" for c in ["record_id", *FIELDS]], *tf_columns(model)
        ).where(blocked)
        alike = with_weights(with_gammas(twins, model.comparisons, tuple(tf_columns(model))), model).where(
            F.col("match_probability") >= threshold
        )
        joined = links.select(F.explode(F.array("src", "dst")).alias("id")).union(alike.select("record_id_l")).distinct()
        groups = connected_components(profiles.select(F.col("record_id").alias("id")), links)
        marked = groups.join(exchanged(joined.withColumn("joined", F.lit(True))), "id", "left")
        # Written, so that the adaptive skew join can split the records of a content with many copies.
        by_content = cut(
            profiles.join(exchanged(marked), F.col("record_id") == F.col("id")).select(
                *[F.col(c).alias(f"p_{c}") for c in FIELDS], "component", "joined"
            ),
            "by-content", outlives=True,
        )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in FIELDS])
    return records.join(exchanged(by_content), same).select(
        "record_id", F.when(F.col("joined"), F.col("component")).otherwise(F.col("record_id")).alias("golden_id")
    )


def link_confidence(scored: DataFrame) -> DataFrame:
    """``(record_id, confidence)``: probability of each linked record's best link."""
    ends = scored.select(F.explode(F.array("record_id_l", "record_id_r")).alias("record_id"), "match_probability")
    return ends.groupBy("record_id").agg(F.max("match_probability").alias("confidence"))


def compression(resolved: DataFrame, guests_raw: DataFrame) -> DataFrame:
    """One row: records, golden guests, records per golden guest and the true number of guests."""
    sized = resolved.groupBy("golden_id").agg(F.count(F.lit(1)).alias("n"))
    true_guests = guests_raw.select("true_id").distinct().agg(F.count(F.lit(1)))
    return sized.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("golden_guests")).select(
        "records", "golden_guests", F.round(F.col("records") / F.col("golden_guests"), 4).alias("compression"),
        true_guests.scalar().alias("true_guests"),
    )


def merge_quality(resolved: DataFrame, guests_raw: DataFrame) -> DataFrame:
    """One row: true groups, and the share of them whose records all carry one golden id."""
    truth = guests_raw.select("record_id", "true_id").join(resolved, "record_id")
    per_group = truth.groupBy("true_id").agg(F.countDistinct("golden_id").alias("n_golden"))
    whole = F.when(F.col("n_golden") == 1, F.lit(1)).otherwise(F.lit(0))
    return per_group.agg(
        F.count(F.lit(1)).alias("true_groups"),
        F.round(F.avg(whole) * 100, 1).alias("pct_true_groups_fully_merged"),
    )


def pair_quality(resolved: DataFrame, guests_raw: DataFrame) -> DataFrame:
    """One row: pairwise precision and recall, from group sizes instead of pairs."""
    truth = guests_raw.select("record_id", "true_id").join(resolved, "record_id")
    cells = truth.groupBy("true_id", "golden_id").agg(F.count(F.lit(1)).alias("n"))

    def pairs(df: DataFrame) -> Column:
        n = F.col("n").cast("double")
        return df.agg(F.sum(n * (n - 1) / 2)).scalar()

    by_golden = cells.groupBy("golden_id").agg(F.sum("n").alias("n"))
    by_truth = cells.groupBy("true_id").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")
    return cells.agg(F.sum(n * (n - 1) / 2).alias("true_positive")).select(
        (F.col("true_positive") / F.nullif(pairs(by_golden), F.lit(0.0))).alias("precision"),
        (F.col("true_positive") / F.nullif(pairs(by_truth), F.lit(0.0))).alias("recall"),
    )
