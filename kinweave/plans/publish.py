"""A whole run written to a catalog schema: tables, documented views, metric view.

``publish_spine`` goes from raw tables to cohort value, ``publish_edge_table`` builds the edge table on top of it
and answers connection questions from it. Each step reads the tables of the steps before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinweave.operators import centrality, relations, traverse
from kinweave.operators.components import connected_components
from kinweave.operators.graph import Graph, edges_of, triangle_count
from kinweave.operators.resolve import blocking, clustering
from kinweave.operators.resolve.model import MatchModel, train
from kinweave.plans import questions, value
from kinweave.sources.catalog import create_view, require_tables, save_table

RAW_TABLES = ("guests_raw", "bookings", "party_members", "transactions")

METRIC_VIEW = """
SELECT segment, sum(total_spend_gbp) AS total_spend_gbp, count(DISTINCT cohort_id) AS cohorts, sum(cohort_members) AS members
FROM cohort_spend GROUP BY segment
"""
LABELED_EDGES_VIEW = """
WITH names AS (
  SELECT golden_id, max_by(name, struct(length(name), name)) AS name
  FROM (SELECT golden_id, concat_ws(' ', first_name, last_name) AS name FROM guests_resolved JOIN guests_raw USING (record_id))
  GROUP BY golden_id
)
SELECT e.subject_id, s.name AS subject_name, e.predicate, e.object_id, o.name AS object_name, e.confidence, e.source_method
FROM gold_triplets e
LEFT JOIN names s ON s.golden_id = e.subject_id
LEFT JOIN names o ON o.golden_id = e.object_id
WHERE e.predicate IN ('VISITED_WITH', 'PAID_FOR')
"""
NODE_DEGREE_VIEW = """
SELECT subject_id AS guest_id, count(*) AS degree FROM gold_triplets WHERE predicate = 'VISITED_WITH' GROUP BY subject_id
"""


def publish_spine(
    spark: SparkSession, model: MatchModel | None = None, pass_percent: int = 5, fmt: str = "parquet"
) -> DataFrame:
    """Resolve, connect and attribute from the raw tables of the current schema; returns the run summary."""
    require_tables(spark, RAW_TABLES)
    raw, bookings, members, transactions = (spark.table(t) for t in RAW_TABLES)

    def save(df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
        return save_table(df, name, comment, fmt=fmt)

    records = blocking.comparison_input(raw)
    resolved = save(
        clustering.resolve(records, model or train(records).model), "guests_resolved",
        "Source record to golden guest.",
    )
    golden = relations.members_golden(members, resolved)
    payers = relations.payers_golden(bookings, resolved)
    guests = resolved.select(F.col("golden_id").alias("id")).distinct()
    cohorts = save(
        connected_components(guests, relations.party_links(golden, payers)).withColumnRenamed("component", "cohort_id"),
        "guest_cohorts", "Activity cohort of each golden guest.",
    )
    edges = relations.all_edges(relations.attended_edges(golden), relations.paid_edges(payers, golden))
    save(centrality.pagerank(Graph(guests, edges)), "guest_influence", "PageRank over attended and paid edges.")
    spend = save(value.cohort_spend(transactions, resolved, cohorts, pass_percent), "cohort_spend")
    create_view(
        spark, "v_cohort_value", value.COHORT_VALUE_QUERY.format(cohort_spend="cohort_spend"),
        value.COHORT_VALUE_COMMENT, value.COHORT_VALUE_COLUMNS,
    )
    return questions.run_summary(
        raw_source_records=raw,
        golden_guests=resolved.select("golden_id").distinct(),
        activity_cohorts=cohorts.select("cohort_id").distinct(),
        cohort_spend_rows=spend,
    )


def publish_edge_table(spark: SparkSession, agent: str = "kinweave", fmt: str = "parquet") -> DataFrame:
    """Write the edge table with its views and graph results; returns the edges per predicate.

    ``agent`` is named as the source of the resolution rows.
    """
    require_tables(spark, (*RAW_TABLES, "guests_resolved", "cohort_spend"))
    resolved = spark.table("guests_resolved")
    golden = relations.members_golden(spark.table("party_members"), resolved)
    payers = relations.payers_golden(spark.table("bookings"), resolved)
    edge_table = save_table(
        relations.triplets(resolved, relations.attended_edges(golden), relations.paid_edges(payers, golden), agent),
        "gold_triplets", "Edge table: one row per subject, predicate and object.", fmt=fmt, partition_by=("predicate",),
    )
    create_view(spark, "mv_cohort_value", METRIC_VIEW, "Spend, cohorts and members by segment.")
    create_view(spark, "v_edges_labeled", LABELED_EDGES_VIEW, "Guest-to-guest edges with names.")
    create_view(spark, "v_node_degree", NODE_DEGREE_VIEW, "Companions per guest.")
    visited = edges_of(edge_table, "VISITED_WITH")
    graph = Graph.from_edges(visited)
    save_table(traverse.two_hop(visited), "guest_2hop", fmt=fmt)
    save_table(centrality.label_propagation(graph), "guest_communities", fmt=fmt)
    save_table(centrality.centrality(graph, centrality.pagerank(graph)), "guest_centrality", fmt=fmt)
    save_table(triangle_count(graph), "guest_triangles", fmt=fmt)
    return relations.predicate_profile(edge_table)
