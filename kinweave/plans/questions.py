"""Analyst questions over the stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kinweave.functions.buckets import stable_bucket


def spend_by_park(transactions: DataFrame, year: int | None = None) -> DataFrame:
    """Total spend per park and year."""
    dated = transactions.select("park", "amount_gbp", F.year(F.col("txn_date").cast("date")).alias("year"))
    if year is not None:
        dated = dated.where(F.col("year") == year)
    return dated.groupBy("park", "year").agg(F.round(F.sum("amount_gbp"), 2).alias("total_spend_gbp"))


def pass_cohorts_by_spend(cohorts: DataFrame, spend: DataFrame, percent: int = 5, method: str = "murmur3") -> DataFrame:
    """Cohorts of the pass holders, ranked by the spend of all their members."""
    holders = (
        cohorts.where(stable_bucket("id", 100, method) < percent)
        .groupBy("cohort_id").agg(F.count(F.lit(1)).alias("pass_holders"))
    )
    return holders.join(spend, "cohort_id").select(
        "cohort_id", "pass_holders", "cohort_members", "total_spend_gbp"
    ).orderBy(F.desc("total_spend_gbp"), "cohort_id")


def influencers_in_top_cohorts(
    cohorts: DataFrame, spend: DataFrame, influence: DataFrame, top_cohorts: int = 5, per_cohort: int = 3
) -> DataFrame:
    """The most influential guests of each of the highest-spending cohorts.

    Each guest's rank is needed only within a cohort's best few, so a cohort is first cut to the best few
    of every hash bucket of guests; the window that ranks a whole cohort sees only those.
    """
    top = spend.orderBy(F.desc("total_spend_gbp"), "cohort_id").limit(top_cohorts).select("cohort_id", "total_spend_gbp")
    score = F.round("pagerank", 6)
    guests = cohorts.join(F.broadcast(top), "cohort_id").join(influence, "id").select(
        "cohort_id", "total_spend_gbp", F.col("id").alias("guest_id"), score.alias("pagerank")
    )
    order = [F.desc("pagerank"), F.asc("guest_id")]
    bucket = F.pmod(F.xxhash64("guest_id"), F.lit(1024))
    best = guests.withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy("cohort_id", "_b").orderBy(*order))
    ).where(F.col("_r") <= per_cohort).drop("_b", "_r")
    return best.withColumn(
        "place", F.row_number().over(Window.partitionBy("cohort_id").orderBy(*order)).cast("long")
    ).where(F.col("place") <= per_cohort)


def companions_of(edge_table: DataFrame, guest: DataFrame, names: DataFrame) -> DataFrame:
    """Whom the one guest in ``guest(seed)`` visited with."""
    with_guest = edge_table.where(F.col("predicate") == "VISITED_WITH").join(
        guest, F.col("subject_id") == F.col("seed")
    ).select("subject_id", F.col("object_id").alias("golden_id"))
    return with_guest.join(names, "golden_id", "left").select(
        F.col("subject_id").alias("guest_id"), F.col("golden_id").alias("companion_id"), F.col("name").alias("companion_name")
    )


def paid_for(labeled: DataFrame, guest_id: str | None = None) -> DataFrame:
    """Who paid for whom, for one guest or for all."""
    paid = labeled.where(F.col("predicate") == "PAID_FOR")
    if guest_id is not None:
        paid = paid.where(F.col("subject_id") == guest_id)
    return paid.select(
        F.col("subject_id").alias("payer_id"), F.col("subject_name").alias("payer_name"),
        F.col("object_id").alias("guest_id"), F.col("object_name").alias("guest_name"),
    )


def spend_by_home_park(transactions: DataFrame, guests_raw: DataFrame) -> DataFrame:
    """Spend of the records that call a park home: total, and average per spending record."""
    per_record = transactions.groupBy("record_id").agg(F.sum("amount_gbp").alias("spend"))
    return per_record.join(guests_raw.select("record_id", "home_park"), "record_id").groupBy("home_park").agg(
        F.count(F.lit(1)).alias("spending_records"),
        F.round(F.sum("spend"), 2).alias("total_spend_gbp"),
        F.round(F.avg("spend"), 2).alias("avg_spend_gbp"),
    )


def run_summary(**stages: DataFrame) -> DataFrame:
    """``(stage, rows)`` of several results."""
    parts = [df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows")) for name, df in stages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
