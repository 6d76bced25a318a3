"""Every query by name, as a function of the session and the input folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinweave.functions.similarity import jaro_winkler
from kinweave.operators import centrality as ranking, relations, traverse
from kinweave.operators.components import connected_components, extended_components
from kinweave.operators.graph import coloured_triangle_count, degrees, edges_of, find_motif, triangle_count, Graph
from kinweave.operators.resolve import alike, blocking, clustering, comparisons, model
from kinweave.plans import metrics, questions, value
from kinweave.plans.stages import PASS_METHOD, Stages, stages
from kinweave.resume import Rounds
from kinweave.session import cut, scratch_path, ship_package
from kinweave.sources import catalog, versions

QUERIES: dict[str, Callable[[Stages], DataFrame]] = {}


def query(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(stages(spark, sf_dir))

        return run

    return {name: bound(fn) for name, fn in QUERIES.items()}


# Source tables

@query
def guests_raw(s):
    return s.source("guests_raw")


@query
def bookings(s):
    return s.source("bookings")


@query
def party_members(s):
    return s.source("party_members")


@query
def transactions(s):
    return s.source("transactions")


# Relationships

@query
def members_golden(s):
    return relations.members_golden(s["party_members"], s["guests_resolved"])


@query
def edges_attended(s):
    return relations.attended_edges(s["members_golden"])


@query
def edges_paid(s):
    return relations.paid_edges(relations.payers_golden(s["bookings"], s["guests_resolved"]), s["members_golden"])


@query
def edges_all(s):
    return relations.all_edges(edges_attended(s), edges_paid(s))


@query
def triplets(s):
    attended, paid = (s["edges"].where(F.col("relationship") == k) for k in ("attended_with", "paid_for"))
    return relations.triplets(s["guests_resolved"], attended, paid)


@query
def triplets_confidence(s):
    """The resolution rows with the probability of each record's best link."""
    best = clustering.link_confidence(s["scored_pairs"])
    attended, paid = (s["edges"].where(F.col("relationship") == k) for k in ("attended_with", "paid_for"))
    found = relations.triplets(s["guests_resolved"], attended, paid, agent="kinweave", confidence=best)
    return found.where(F.col("predicate") == "RESOLVES_TO").select(
        "subject_id", "object_id", F.round("confidence", 6).alias("confidence"), "source_agent"
    )


@query
def predicate_profile(s):
    return relations.predicate_profile(s["gold_triplets"])


@query
def guest_names(s):
    return relations.guest_names(s["guests_resolved"], s["guests_raw"])


@query
def edges_labeled(s):
    return relations.labeled_edges(s["gold_triplets"], s["guest_names"])


@query
def node_degree(s):
    return relations.companion_degree(s["gold_triplets"])


@query
def top_degree(s):
    return relations.most_connected(node_degree(s), s["guest_names"])


# Graph

@query
def graph_vertices(s):
    return s.visit_graph().vertices


@query
def graph_size(s):
    return s.visit_graph().size()


@query
def cohorts(s):
    return s["guest_cohorts"]


@query
def cohorts_in_batches(s):
    """The cohorts when guests and links come in three batches, each added to the labels of those before.

    Guests and links are dealt once, into a folder per batch; a batch reads its own.
    """
    guests = s["guests_resolved"].select(F.col("golden_id").alias("id")).distinct()
    guests, links = (
        cut(df.withColumn("batch", F.pmod(F.xxhash64(*df.columns), F.lit(3))), name, partition_by=("batch",))
        for df, name in ((guests, "guest-batches"), (s["party_links"], "link-batches"))
    )
    labels = guests.limit(0).select("id", F.col("id").alias("component"))
    for batch in range(3):
        labels = extended_components(labels, *(df.where(F.col("batch") == batch) for df in (guests, links)))
    return labels.withColumnRenamed("component", "cohort_id")


@query
def cohorts_resumed(s):
    """The cohorts by a loop that ends after its first round and is taken up again from what it left in a folder."""
    links = s["party_links"]
    guests = s["guests_resolved"].select(F.col("golden_id").alias("id")).distinct()
    folder = scratch_path(s.spark, "lasting-rounds")
    with suppress(RuntimeError):
        connected_components(guests, links, max_rounds=1, rounds=Rounds(s.spark, folder, "cohorts"))
    found = connected_components(guests, links, rounds=Rounds(s.spark, folder, "cohorts"))
    return found.withColumnRenamed("component", "cohort_id")


@query
def top_cohorts(s):
    return value.cohort_sizes(s["guest_cohorts"])


@query
def pagerank(s):
    return s["guest_influence"].select("id", F.round("pagerank", 6).alias("pagerank"))


@query
def top_influence(s):
    return pagerank(s).orderBy(F.desc("pagerank"), "id").limit(10)


@query
def communities(s):
    return s["guest_communities"]


@query
def degree(s):
    return degrees(edges_of(s["gold_triplets"], "VISITED_WITH"))


@query
def centrality(s):
    ranked = s["visit_influence"].select("id", F.round("pagerank", 6).alias("pagerank"))
    return ranking.centrality(Graph.from_edges(edges_of(s["gold_triplets"], "VISITED_WITH")), ranked)


@query
def triangles(s):
    return triangle_count(s.visit_graph())


@query
def triangles_coloured(s):
    """The triangles through each guest, counted inside cells of coloured guests."""
    return coloured_triangle_count(s.visit_graph(), colours=6)


@query
def motif(s):
    edges = edges_of(s["gold_triplets"], "VISITED_WITH").withColumn("rel", F.lit("VISITED_WITH")).unionByName(
        edges_of(s["gold_triplets"], "PAID_FOR").withColumn("rel", F.lit("PAID_FOR"))
    )
    found = find_motif(
        Graph(s.visit_graph().vertices, edges),
        [("a", "e1", "b"), ("b", "e2", "c")],
        {"e1": F.col("rel") == "VISITED_WITH", "e2": F.col("rel") == "PAID_FOR"},
    )
    return found.where(F.col("a.id") != F.col("c.id")).select(
        F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("c.id").alias("c_id")
    )


@query
def khop(s):
    return traverse.guests_per_depth(
        traverse.reach_by_paths(edges_of(s["gold_triplets"], "VISITED_WITH"), s.most_connected_guest())
    )


@query
def khop_paths(s):
    """Guests at the end of simple paths of up to four edges."""
    return traverse.guests_per_depth(
        traverse.reach_by_paths(edges_of(s["gold_triplets"], "VISITED_WITH"), s.most_connected_guest(), max_hops=4)
    )


@query
def khop_paths_deep(s):
    """Guests at the end of simple paths of up to six edges."""
    return traverse.guests_per_depth(
        traverse.reach_by_paths(edges_of(s["gold_triplets"], "VISITED_WITH"), s.most_connected_guest(), max_hops=6)
    )


@query
def khop_distance(s):
    return traverse.guests_per_depth(
        traverse.reach_by_distance(edges_of(s["gold_triplets"], "VISITED_WITH"), s.most_connected_guest())
    )


@query
def two_hop(s):
    return s["guest_2hop"]


@query
def two_hop_histogram(s):
    return traverse.hop_histogram(s["guest_2hop"])


@query
def hop_histogram_sketched(s):
    """Pairs of guests by distance, up to three hops, from sketches."""
    return traverse.sketched_hop_histogram(edges_of(s["gold_triplets"], "VISITED_WITH"), max_hops=3, lg_k=13)


# Value

@query
def txn_cohort(s):
    return value.transactions_with_cohort(s["transactions"], s["guests_resolved"], s["guest_cohorts"])


@query
def pass_holders(s):
    return value.pass_holders(s["guest_cohorts"], method=PASS_METHOD)


@query
def pass_holders_murmur(s):
    """The sample by Spark's own hash."""
    return value.pass_holders(s["guest_cohorts"])


@query
def cohort_spend(s):
    return value.cohort_spend(s["transactions"], s["guests_resolved"], s["guest_cohorts"], method=PASS_METHOD)


@query
def segment_summary(s):
    return value.segment_summary(s["cohort_spend"])


@query
def cohort_value(s):
    return s.spark.sql(value.COHORT_VALUE_QUERY, cohort_spend=s["cohort_spend"])


def _published(s):
    """The tables written to a catalog schema and checked, with the documented view over them.

    Each run has folders of its own, as another application's files may lie in the warehouse, which knows nothing of its catalog.
    """
    here = s.spark.catalog.currentDatabase()
    catalog.use_schema(s.spark, "kinweave_published")
    try:
        spend, cohorts = (scratch_path(s.spark, f"published-{name}") for name in ("spend", "cohorts"))
        catalog.save_table(
            s["cohort_spend"], "cohort_spend", "Spend of each cohort.", {"segment": "With or without a pass holder."}, path=spend
        )
        catalog.save_table(s["guest_cohorts"], "guest_cohorts", "Activity cohort of each golden guest.", path=cohorts)
        catalog.require_tables(s.spark, ("cohort_spend", "guest_cohorts"))
        return catalog.create_view(
            s.spark, "v_cohort_value", value.COHORT_VALUE_QUERY.format(cohort_spend="kinweave_published.cohort_spend"),
            value.COHORT_VALUE_COMMENT, value.COHORT_VALUE_COLUMNS,
        )
    finally:
        s.spark.catalog.setCurrentDatabase(here)


@query
def published_cohort_value(s):
    """Cohort value from a catalog schema: tables written and checked, the documented view over them read back."""
    view = _published(s)
    sizes = s.spark.table("kinweave_published.guest_cohorts").groupBy("cohort_id").agg(F.count(F.lit(1)).alias("guests"))
    return view.join(sizes, "cohort_id")


@query
def replaced_cohort_spend(s):
    """Cohort spend replaced by a table with a further column: a reader from before has the old rows, one from after the new."""
    here, name = s.spark.catalog.currentDatabase(), "kinweave_published.cohort_report"
    catalog.use_schema(s.spark, "kinweave_published")
    s.spark.catalog.setCurrentDatabase(here)
    spend = s["cohort_spend"]
    early = versions.replace_table(spend.select("cohort_id", F.col("cohort_members").alias("members")), name)
    late = versions.replace_table(
        spend.select("cohort_id", F.col("cohort_members").alias("members"), "total_spend_gbp"), name, "Spend of each cohort.",
    )
    return early.withColumnRenamed("members", "members_before").join(late, "cohort_id")


@query
def published_comments(s):
    """Each column of the documented view with its comment, the view's, and how many values are known and different."""
    view = _published(s)
    counts = view.agg(*[f(c).alias(f"{c}_{n}") for c in view.columns for n, f in (("known", F.count), ("different", F.countDistinct))])
    of_view, of_column = catalog.comments(s.spark, "kinweave_published.v_cohort_value")
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(of_column.get(c)).alias("column_comment"), F.lit(of_view).alias("view_comment"),
            F.col(f"{c}_known").alias("known"), F.col(f"{c}_different").alias("different"),
        ) for c in view.columns
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


@query
def predicate_glossary(s):
    """The edge table's predicates with their meaning, from a hand-made table, and their number."""
    glossary = catalog.table_from_rows(s.spark, relations.GLOSSARY, "predicate string, meaning string")
    counts = s["gold_triplets"].groupBy("predicate").agg(F.count(F.lit(1)).alias("edges"))
    return counts.join(F.broadcast(glossary), "predicate")


@query
def metric_cohort_value(s):
    found = metrics.cohort_value_metrics(s["cohort_spend"]).query()
    return found.withColumn("total_spend_gbp", F.round("total_spend_gbp", 2))


@query
def metric_spend_grains(s):
    """Spend, transactions, guests and cohorts at three grains, rolled up from one stored cube that was filled in two batches.

    The distinct counts are exact; ``sketch_holds`` says that those of the cube lie within four standard errors.
    """
    spent = s["transactions"].join(s["guests_resolved"], "record_id").join(s["guest_cohorts"].withColumnRenamed("id", "golden_id"), "golden_id")
    cube = metrics.spend_cube()
    late = F.substring("txn_date", 6, 2) > "06"
    stored = cut(cube.merged(cube.stored(spent.where(late)), cube.stored(spent.where(~F.coalesce(late, F.lit(False))))), "cube")
    grains = [["park", "year"], ["year"], []]
    about, exact = cube.rolled_up(stored, grains), cube.exact(spent, grains)
    keys = ["grain", "park", "year"]
    about = about.select(*[F.col(k).alias(f"_{k}") for k in keys], "spend_gbp", "transactions", *[F.col(m).alias(f"_{m}") for m in cube.distinct])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    near = [F.abs(F.col(m) - F.col(f"_{m}")) <= 4 * cube.error * F.col(m) for m in cube.distinct]
    return exact.drop("spend_gbp", "transactions").join(about, same).select(
        *keys, F.round("spend_gbp", 2).alias("spend_gbp"), "transactions", *cube.distinct, reduce(Column.__and__, near).alias("sketch_holds"),
    )


@query
def run_summary(s):
    return questions.run_summary(
        raw_source_records=s["guests_raw"],
        golden_guests=s["guests_resolved"].select("golden_id").distinct(),
        activity_cohorts=s["guest_cohorts"].select("cohort_id").distinct(),
        cohort_spend_rows=s["cohort_spend"],
    )


# Entity resolution with the given model

@query
def er_candidates(s):
    return blocking.candidate_pairs(s.records).select("record_id_l", "record_id_r", "match_key")


@query
def er_name_similarity(s):
    pairs = blocking.candidate_pairs(s.records)
    names = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("field"),
            F.least(f"{c}_l", f"{c}_r").alias("name_a"), F.greatest(f"{c}_l", f"{c}_r").alias("name_b"),
        )
        for c in ("first_name", "last_name")
    ]))
    distinct = pairs.select(names.alias("e")).select("e.*").distinct()
    return distinct.withColumn("similarity", F.round(jaro_winkler("name_a", "name_b"), 6))


@query
def er_alike_in_district(s):
    """Pairs of records in one postcode district with similar first and similar last names."""
    records = s["guests_raw"].select(
        "record_id", "first_name", "last_name", F.substring_index("postcode", " ", 1).alias("district")
    )
    names = [(F.col("first_name"), 0.9), (F.col("last_name"), 0.9)]
    return alike.alike_pairs(records, ("district",), names).select("record_id_l", "record_id_r", F.col("district_l").alias("district"))


@query
def er_gammas(s):
    return comparisons.with_gammas(blocking.candidate_pairs(s.records), comparisons.guest_comparisons())


@query
def er_term_freq(s):
    return comparisons.term_frequencies(s.records, "phone").select("phone", F.round("tf_phone", 9).alias("tf_phone"))


@query
def er_prior(s):
    return model.estimate_prior(s.records).withColumn("prior", F.round("prior", 9))


@query
def er_u_probs(s):
    return s["u_levels"].withColumn("u_prob", F.round("u_prob", 9))


@query
def er_scored(s):
    m = model.GIVEN_MODEL
    return s["scored_pairs"].select(
        "record_id_l", "record_id_r", "match_key",
        *[f"gamma_{c.name}" for c in m.comparisons],
        F.round("match_weight", 4).alias("match_weight"), F.round("match_probability", 6).alias("match_probability"),
    )


@query
def er_explain(s):
    return model.explain(s["scored_pairs"], model.GIVEN_MODEL).withColumn("bits", F.round("bits", 4))


@query
def er_clusters(s):
    return s["guests_resolved"]


@query
def er_compression(s):
    return clustering.compression(s["guests_resolved"], s["guests_raw"])


@query
def er_quality(s):
    return clustering.merge_quality(s["guests_resolved"], s["guests_raw"])


@query
def er_pair_quality(s):
    """Share of the pairs put together that are true, and of the true pairs that are put together."""
    found = clustering.pair_quality(s["guests_resolved"], s["guests_raw"])
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


# Entity resolution with the trained model

@query
def er_em(s):
    rows = s.training().rows()
    found = s.spark.createDataFrame(rows, "session string, comparison string, level int, m_prob double, u_prob double")
    return found.withColumn("m_prob", F.round("m_prob", 5)).withColumn("u_prob", F.round("u_prob", 9))


@query
def er_learned_clusters(s):
    return s["resolved_learned"]


@query
def er_learned_compression(s):
    return clustering.compression(s["resolved_learned"], s["guests_raw"])


@query
def er_learned_quality(s):
    return clustering.merge_quality(s["resolved_learned"], s["guests_raw"])


# Analyst questions

@query
def q_spend_by_park(s):
    return questions.spend_by_park(s["transactions"])


@query
def q_pass_cohort_rank(s):
    return questions.pass_cohorts_by_spend(s["guest_cohorts"], s["cohort_spend"], method=PASS_METHOD)


@query
def q_influencers_top_cohorts(s):
    return questions.influencers_in_top_cohorts(s["guest_cohorts"], s["cohort_spend"], s["guest_influence"])


@query
def q_within_two_hops(s):
    return traverse.two_hop(edges_of(s["gold_triplets"], "VISITED_WITH"), s.most_connected_guest())


@query
def q_companions_of_top(s):
    return questions.companions_of(s["gold_triplets"], s.most_connected_guest(), s["guest_names"])


@query
def q_paid_for(s):
    return questions.paid_for(relations.labeled_edges(s["gold_triplets"], s["guest_names"]))


@query
def q_uplift(s):
    return value.uplift(s["cohort_spend"])


@query
def q_spend_by_home_park(s):
    return questions.spend_by_home_park(s["transactions"], s["guests_raw"])
