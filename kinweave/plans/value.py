"""Spend attributed to the groups the graph finds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinweave.functions.buckets import stable_bucket
from kinweave.session import exchanged

WITH_PASS, WITHOUT_PASS = "has_pass_holder", "no_pass_holder"

COHORT_VALUE_COMMENT = "Size and park revenue of every cohort, one row each, split by the pass campaign."
COHORT_VALUE_COLUMNS = {
    "cohort_id": "Smallest golden id among the guests that bookings and payments tie together.",
    "segment": "has_pass_holder if any member got a campaign pass, no_pass_holder otherwise.",
    "cohort_members": "How many golden guests belong to the cohort, those who never spent included.",
    "total_spend_gbp": "Pounds spent in the parks by all members, rounded to pence.",
}
COHORT_VALUE_QUERY = "SELECT cohort_id, segment, cohort_members, total_spend_gbp FROM {cohort_spend}"


def cohort_sizes(cohorts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest cohorts."""
    return (
        cohorts.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("cohort_size"))
        .orderBy(F.desc("cohort_size"), "cohort_id").limit(k)
    )


def transactions_with_cohort(transactions: DataFrame, resolved: DataFrame, cohorts: DataFrame) -> DataFrame:
    return (
        transactions.select("txn_id", "record_id", "amount_gbp").join(resolved, "record_id")
        .join(exchanged(cohorts), F.col("golden_id") == F.col("id"))
        .select("txn_id", "amount_gbp", "cohort_id", "golden_id")
    )


def pass_holders(cohorts: DataFrame, percent: int = 5, method: str = "murmur3") -> DataFrame:
    """A stable sample of about ``percent`` in a hundred guests."""
    return cohorts.where(stable_bucket("id", 100, method) < percent).select(F.col("id").alias("golden_id"))


def guest_spend(transactions: DataFrame, resolved: DataFrame) -> DataFrame:
    """Spend per golden guest, added up per source record before the join to the identity map."""
    per_record = transactions.groupBy("record_id").agg(F.sum("amount_gbp").alias("spend"))
    return per_record.join(exchanged(resolved), "record_id").groupBy("golden_id").agg(F.sum("spend").alias("spend"))


def cohort_spend(
    transactions: DataFrame, resolved: DataFrame, cohorts: DataFrame, percent: int = 5, method: str = "murmur3"
) -> DataFrame:
    """Per cohort: segment, distinct members and rounded spend; guests without spend count as zero.

    Spend is reduced to one row per guest and then, with the pass flag, to one row per cohort, so the
    transactions never meet the cohort key and a cohort holding most guests is combined map-side.
    """
    holder = F.max((stable_bucket("id", 100, method) < percent).cast("int"))
    spend = guest_spend(transactions, resolved)
    return (
        cohorts.join(exchanged(spend), F.col("id") == F.col("golden_id"), "left")
        .groupBy("cohort_id")
        .agg(
            holder.alias("flag"),
            F.count("id").alias("cohort_members"),
            F.round(F.sum(F.coalesce("spend", F.lit(0.0))), 2).alias("total_spend_gbp"),
        )
        .select(
            "cohort_id", F.when(F.col("flag") == 1, WITH_PASS).otherwise(WITHOUT_PASS).alias("segment"),
            "cohort_members", "total_spend_gbp",
        )
    )


def segment_summary(spend: DataFrame) -> DataFrame:
    """Cohorts with a pass holder against the rest; spend per member is averaged over cohorts."""
    per_member = F.col("total_spend_gbp") / F.nullif(F.col("cohort_members"), F.lit(0))
    return spend.groupBy("segment").agg(
        F.count(F.lit(1)).alias("cohorts"),
        F.round(F.avg("total_spend_gbp"), 2).alias("avg_cohort_spend_gbp"),
        F.round(F.avg(per_member), 2).alias("avg_spend_per_member_gbp"),
    ).orderBy("segment")


def uplift(spend: DataFrame) -> DataFrame:
    """One row: average cohort spend with and without a pass holder, and the difference."""
    with_pass, without = (
        F.avg(F.when(F.col("segment") == s, F.col("total_spend_gbp"))) for s in (WITH_PASS, WITHOUT_PASS)
    )
    return spend.agg(
        F.round(with_pass, 2).alias("avg_with_pass_gbp"), F.round(without, 2).alias("avg_without_pass_gbp"),
        F.round(with_pass - without, 2).alias("uplift_gbp"),
    )
