import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import centrality, relations
from kinweave.operators.components import connected_components
from kinweave.operators.graph import Graph
from kinweave.operators.skew import sliced_join
from kinweave.plans import metrics, questions, value


@pytest.fixture(scope="module")
def worked(spark):
    """Ana = 1, Chi = 2, Ben = 3: Ana and Chi visit and Ana pays, Ben visits alone and pays."""
    resolved = spark.createDataFrame([("ra", "1"), ("rc", "2"), ("rb", "3")], "record_id string, golden_id string")
    members = spark.createDataFrame(
        [("p1", "ra", "b1"), ("p1", "rc", "b1"), ("p2", "rb", "b2")], "party_id string, record_id string, booking_id string"
    )
    bookings = spark.createDataFrame(
        [("b1", "p1", "ra", "park0", "2024-05-01"), ("b2", "p2", "rb", "park1", "2024-05-02")],
        "booking_id string, party_id string, payer_record_id string, park string, booking_date string",
    )
    spend = spark.createDataFrame(
        [("t1", "ra", "park0", 40.0, "2024-05-01"), ("t2", "rc", "park0", 30.0, "2023-05-01"), ("t3", "rb", "park1", 25.0, "2024-05-02")],
        "txn_id string, record_id string, park string, amount_gbp double, txn_date string",
    )
    golden = relations.members_golden(members, resolved)
    payers = relations.payers_golden(bookings, resolved)
    return dict(resolved=resolved, golden=golden, payers=payers, spend=spend,
                vertices=resolved.select(F.col("golden_id").alias("id")))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_worked_example(worked, spark):
    attended = relations.attended_edges(worked["golden"])
    paid = relations.paid_edges(worked["payers"], worked["golden"])
    assert rows(attended) == [("1", "2", "attended_with")]
    assert rows(paid) == [("1", "2", "paid_for")]
    edges = relations.all_edges(attended, paid)
    cohorts = connected_components(worked["vertices"], edges).withColumnRenamed("component", "cohort_id")
    assert rows(cohorts) == [("1", "1"), ("2", "1"), ("3", "3")]
    spend = value.cohort_spend(worked["spend"], worked["resolved"], cohorts, percent=0)
    assert rows(spend.select("cohort_id", "cohort_members", "total_spend_gbp")) == [("1", 2, 70.0), ("3", 1, 25.0)]
    # Rank flows along the edge from the payer, so the guest paid for ends up above the payer.
    ranks = dict(rows(centrality.pagerank(Graph(worked["vertices"], paid), iterations=10, normalized=False)))
    assert ranks == pytest.approx({"1": 0.15, "2": 0.2775, "3": 0.15})
    back = relations.paid_edges(worked["payers"], worked["golden"], reverse=True)
    ranks = dict(rows(centrality.pagerank(Graph(worked["vertices"], back), normalized=False)))
    assert ranks["1"] > ranks["2"]


def test_triplets_of_the_worked_example(worked, spark):
    attended = relations.attended_edges(worked["golden"])
    paid = relations.paid_edges(worked["payers"], worked["golden"])
    table = relations.triplets(worked["resolved"], attended, paid)
    assert table.columns == relations.TRIPLET_COLUMNS
    assert rows(table.select("subject_id", "predicate", "object_id", "confidence", "source_agent")) == sorted([
        ("ra", "RESOLVES_TO", "1", 0.95, "splink"), ("rc", "RESOLVES_TO", "2", 0.95, "splink"),
        ("rb", "RESOLVES_TO", "3", 0.95, "splink"), ("1", "VISITED_WITH", "2", 1.0, "graph_build"),
        ("2", "VISITED_WITH", "1", 1.0, "graph_build"), ("1", "PAID_FOR", "2", 1.0, "graph_build"),
    ])
    sure = spark.createDataFrame([("ra", 0.99)], "record_id string, confidence double")
    symmetric = relations.attended_edges(worked["golden"], symmetric=True)
    named = relations.triplets(worked["resolved"], symmetric, paid, agent="kinweave", confidence=sure)
    found = {r.subject_id: r.confidence for r in named.where("predicate = 'RESOLVES_TO'").collect()}
    assert found == {"ra": 0.99, "rb": 0.95, "rc": 0.95}
    assert named.where("predicate = 'VISITED_WITH'").count() == 2
    assert named.where("source_agent = 'kinweave'").count() == 3


def random_parties(spark, seed, guests=40, parties=60):
    rnd = random.Random(seed)
    members = [(f"p{p}", f"b{p}", f"g{rnd.randrange(guests):02d}") for p in range(parties) for _ in range(rnd.choice([1, 1, 2, 3]))]
    members += [("hot", "bhot", f"g{i:02d}") for i in range(0, guests, 2)]
    payers = [(f"p{p}", f"g{rnd.randrange(guests):02d}") for p in range(0, parties, 2)]
    m = spark.createDataFrame(members, "party_id string, booking_id string, golden_id string").distinct()
    return m, spark.createDataFrame(payers, "party_id string, payer string"), members, payers


@pytest.mark.parametrize("slice_rows", [5_000, 3])
def test_hot_party_is_whole(spark, slice_rows):
    m, _, members, _ = random_parties(spark, 1)
    by_party = {}
    for p, _, g in members:
        by_party.setdefault(p, set()).add(g)
    want = {tuple(sorted(pair)) for gs in by_party.values() for pair in itertools.combinations(gs, 2)}
    got = [(r.src, r.dst) for r in relations.attended_edges(m, slice_rows=slice_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("seed", [4])
def test_party_links_connect_what_the_edges_connect(spark, seed):
    m, payers, _, _ = random_parties(spark, seed, guests=80, parties=30)
    m = m.where("party_id <> 'hot'")
    vertices = m.select(F.col("golden_id").alias("id")).union(payers.select("payer")).distinct()
    edges = relations.all_edges(relations.attended_edges(m), relations.paid_edges(payers, m))
    links = relations.party_links(m, payers)
    assert rows(connected_components(vertices, links)) == rows(connected_components(vertices, edges))


@pytest.mark.parametrize("slice_rows", [1_000, 4])
def test_sliced_join_equals_plain_join(spark, slice_rows):
    rnd = random.Random(2)
    a = [(rnd.choice(["h", "h", "x", "y", None]), i) for i in range(60)]
    b = [(rnd.choice(["h", "x", "x", "z", None]), i) for i in range(50)]
    left = spark.createDataFrame(a, "k string, i long")
    right = spark.createDataFrame(b, "k2 string, j long")
    want = sorted((k, i, q, j) for k, i in a for q, j in b if k is not None and k == q and i != j)
    got = sliced_join(left, right, ["k"], ["k2"], F.col("i") != F.col("j"), slice_rows=slice_rows)
    assert rows(got) == want


def test_names_take_the_longest_then_the_last(spark):
    resolved = spark.createDataFrame([("r1", "g1"), ("r2", "g1"), ("r3", "g1"), ("r4", "g2")], "record_id string, golden_id string")
    raw = spark.createDataFrame(
        [("r1", "Al", "Ito"), ("r2", "Alex", "Ito"), ("r3", "Axel", "Ito"), ("r4", "太郎", "佐藤")],
        "record_id string, first_name string, last_name string",
    )
    assert rows(relations.guest_names(resolved, raw)) == [("g1", "Axel Ito"), ("g2", "太郎 佐藤")]


def test_segments_and_uplift(spark):
    spend = spark.createDataFrame(
        [("c1", value.WITH_PASS, 2, 10.0), ("c2", value.WITH_PASS, 1, 20.0), ("c3", value.WITHOUT_PASS, 4, 8.0)],
        "cohort_id string, segment string, cohort_members long, total_spend_gbp double",
    )
    # Spend per member is the average of 5 and 20, not 30 over 3.
    assert rows(value.segment_summary(spend)) == [(value.WITH_PASS, 2, 15.0, 12.5), (value.WITHOUT_PASS, 1, 8.0, 2.0)]
    assert tuple(value.uplift(spend).first()) == (15.0, 8.0, 7.0)
    view = metrics.cohort_value_metrics(spend)
    assert rows(view.query()) == [(value.WITH_PASS, 30.0, 2, 3), (value.WITHOUT_PASS, 8.0, 1, 4)]
    assert rows(view.query([], ["members"])) == [(7,)]
    with pytest.raises(ValueError):
        view.query(["nothing"])


def test_pass_holder_bucket_methods(spark):
    ids = spark.range(2000).select(F.format_string("g%012d", "id").alias("id"), F.lit("c").alias("cohort_id"))
    for method in ("murmur3", "md5"):
        n = value.pass_holders(ids, method=method).count()
        assert 60 < n < 140
    reference = ids.where(F.expr("abs(cast(hash(id) as bigint)) % 100 < 5")).count()
    assert value.pass_holders(ids).count() == reference
    with pytest.raises(ValueError):
        value.pass_holders(ids, method="other")


def test_spend_questions(worked):
    by_park = rows(questions.spend_by_park(worked["spend"]))
    assert by_park == [("park0", 2023, 30.0), ("park0", 2024, 40.0), ("park1", 2024, 25.0)]
    assert rows(questions.spend_by_park(worked["spend"], 2023)) == [("park0", 2023, 30.0)]
