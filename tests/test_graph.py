import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from kinweave.operators import centrality, relations, traverse
from kinweave.operators.components import connected_components, extended_components
from kinweave.operators.graph import Graph, coloured_triangle_count, degrees, find_motif, triangle_count, vertices_of
from kinweave.plans import value

GRAPHS = {
    "empty": ([1, 2], []),
    "isolated": ([1, 2, 3], [(1, 2)]),
    "self_loop": ([1, 2], [(1, 1), (1, 2)]),
    "parallel": ([1, 2, 3], [(1, 2), (1, 2), (2, 3)]),
    "two_cycle": ([1, 2], [(1, 2), (2, 1)]),
    "path": (list(range(30)), [(i, i + 1) for i in range(29)]),
    "shuffled_path": (list(range(30)), [((i * 7) % 30, ((i + 1) * 7) % 30) for i in range(29)]),
    "star": (list(range(12)), [(5, i) for i in range(12) if i != 5]),
    "k4": ([1, 2, 3, 4], list(itertools.combinations([1, 2, 3, 4], 2))),
}


def make(spark, vertices, edges, kind="string"):
    cast = (lambda x: f"v{x:03d}") if kind == "string" else int
    v = spark.createDataFrame([(cast(x),) for x in vertices], f"id {kind}")
    e = spark.createDataFrame([(cast(a), cast(b)) for a, b in edges], f"src {kind}, dst {kind}")
    return Graph(v, e)


def union_find(vertices, edges):
    parent = {v: v for v in vertices}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {v: root(v) for v in vertices}


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def together(names):
    """The named graphs side by side, as one graph that keeps them apart."""
    vertices, edges = [], []
    for i, name in enumerate(names):
        v, e = GRAPHS[name]
        vertices += [100 * i + x for x in v]
        edges += [(100 * i + a, 100 * i + b) for a, b in e]
    return vertices, edges


@pytest.mark.parametrize("kind", ["string", "long"])
def test_components_of_small_graphs(spark, kind):
    vertices, edges = together(GRAPHS)
    g = make(spark, vertices, edges, kind)
    want = union_find(vertices, edges)
    if kind == "string":
        want = {f"v{k:03d}": f"v{v:03d}" for k, v in want.items()}
    assert as_dict(connected_components(g.vertices, g.edges)) == want


def test_components_without_edges(spark):
    g = make(spark, [3, 1], [], "long")
    assert as_dict(connected_components(g.vertices, g.edges)) == {1: 1, 3: 3}


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    vertices = list(range(200))
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(rnd.randrange(1, 220))]
    g = make(spark, vertices, edges, "long")
    assert as_dict(connected_components(g.vertices, g.edges)) == union_find(vertices, edges)


def pagerank_by_hand(vertices, edges, rounds=10):
    out = Counter(a for a, _ in edges)
    rank = {v: 1.0 for v in vertices}
    for _ in range(rounds):
        gain = defaultdict(float)
        for a, b in edges:
            gain[b] += rank[a] / out[a]
        rank = {v: 0.15 + 0.85 * gain[v] for v in vertices}
    return rank


@pytest.mark.parametrize("slice_edges", [500_000, 2])
def test_pagerank(spark, slice_edges):
    vertices, edges = together(["isolated", "parallel", "two_cycle", "star", "k4", "self_loop"])
    g = make(spark, vertices, edges, "long")
    want = pagerank_by_hand(vertices, edges)
    got = as_dict(centrality.pagerank(g, normalized=False, slice_edges=slice_edges))
    assert got == pytest.approx(want)
    scaled = as_dict(centrality.pagerank(g, slice_edges=slice_edges))
    assert sum(scaled.values()) == pytest.approx(len(vertices))


def labels_by_hand(vertices, edges, rounds=5):
    label = {v: v for v in vertices}
    for _ in range(rounds):
        heard = defaultdict(Counter)
        for a, b in edges:
            heard[b][label[a]] += 1
            heard[a][label[b]] += 1
        label = {
            v: min(heard[v], key=lambda x: (-heard[v][x], x)) if heard[v] else label[v] for v in vertices
        }
    return label


@pytest.mark.parametrize("slice_edges", [500_000, 2])
def test_label_propagation(spark, slice_edges):
    vertices, edges = together(["isolated", "parallel", "star", "k4", "path"])
    got = as_dict(centrality.label_propagation(make(spark, vertices, edges, "long"), slice_edges=slice_edges))
    assert got == labels_by_hand(vertices, edges)


def test_label_propagation_random(spark):
    rnd = random.Random(3)
    vertices = list(range(40))
    edges = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(90)]
    got = as_dict(centrality.label_propagation(make(spark, vertices, edges, "long"), cut_every=2, slice_edges=4))
    assert got == labels_by_hand(vertices, edges)


def test_degrees_leave_out_isolated_vertices(spark):
    g = make(spark, *GRAPHS["isolated"], "long")
    assert as_dict(degrees(g.edges)) == {1: 1, 2: 1}
    assert {r.id for r in vertices_of(g.edges).collect()} == {1, 2}
    assert tuple(g.size().first()) == (3, 1)


@pytest.mark.parametrize("slice_rows", [5_000, 3])
def test_triangles(spark, slice_rows):
    g = make(spark, *GRAPHS["k4"], "long")
    assert as_dict(triangle_count(g, slice_rows)) == {1: 3, 2: 3, 3: 3, 4: 3}
    rnd = random.Random(5)
    edges = [(rnd.randrange(25), rnd.randrange(25)) for _ in range(120)]
    pairs = {tuple(sorted(e)) for e in edges if e[0] != e[1]}
    want = Counter({v: 0 for v in range(25)})
    for t in itertools.combinations(range(25), 3):
        if all(p in pairs for p in itertools.combinations(t, 2)):
            want.update(t)
    got = as_dict(triangle_count(make(spark, range(25), edges, "long"), slice_rows))
    assert got == dict(want)
    assert sum(got.values()) % 3 == 0


@pytest.mark.parametrize("colours", [None, 1, 2, 5])
def test_coloured_triangles_equal_triangles(spark, colours):
    rnd = random.Random(8)
    edges = [(rnd.randrange(30), rnd.randrange(30)) for _ in range(220)] + [(0, v) for v in range(30)]
    g = make(spark, range(32), edges, "long")
    want = as_dict(triangle_count(g))
    assert as_dict(coloured_triangle_count(g, colours, cell_edges=40)) == want and sum(want.values()) > 100
    empty = make(spark, range(3), [], "long")
    assert as_dict(coloured_triangle_count(empty, colours)) == {0: 0, 1: 0, 2: 0}


def test_coloured_triangles_shuffle_no_wedge(spark, monkeypatch):
    """The joins of a cell follow one another without an exchange; only the counts of vertices are shuffled after them."""
    from kinweave.operators import graph as module

    plans, plain = {}, module.cut

    def seen(df, name="cut", *args, **options):
        if name == "triangles":
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name, *args, **options)

    monkeypatch.setattr(module, "cut", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = [(a, b) for a in range(12) for b in range(a)]
        g = make(spark, range(12), edges, "long")
        assert set(as_dict(coloured_triangle_count(g, 3)).values()) == {55}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    # From the scan of the cells up to the partial counts of corners there is none; the others are of the vertices' side.
    corners = plans["triangles"][plans["triangles"].index("SortMergeJoin [cell") :]
    assert corners.count("SortMergeJoin") >= 2 and "Exchange" not in corners


@pytest.mark.parametrize("slice_rows", [5_000, 2])
def test_motif_chain_and_cycle(spark, slice_rows):
    rnd = random.Random(6)
    edges = sorted({(rnd.randrange(10), rnd.randrange(10), rnd.choice("vp")) for _ in range(60)})
    g = Graph(
        spark.createDataFrame([(i,) for i in range(9)], "id long"),
        spark.createDataFrame(edges, "src long, dst long, rel string"),
    )
    found = find_motif(
        g, [("a", "e1", "b"), ("b", "e2", "c")], {"e1": F.col("rel") == "v", "e2": F.col("rel") == "p"}, slice_rows
    ).where("a.id <> c.id").select("a.id", "b.id", "c.id", "e1.rel", "e2.rel")
    inside = [e for e in edges if e[0] < 9 and e[1] < 9]
    want = sorted(
        (x[0], x[1], y[1], "v", "p") for x in inside for y in inside
        if x[2] == "v" and y[2] == "p" and x[1] == y[0] and x[0] != y[1]
    )
    assert sorted(map(tuple, found.collect())) == want
    cycles = find_motif(g, [("a", "e1", "b"), ("b", "e2", "a")], slice_rows=slice_rows).count()
    assert cycles == sum(x[1] == y[0] and x[0] == y[1] for x in inside for y in inside)
    loops = find_motif(g, [("a", "e1", "a")]).count()
    assert loops == sum(x[0] == x[1] for x in inside)


def test_motif_needs_a_shared_vertex(spark):
    g = make(spark, *GRAPHS["k4"], "long")
    with pytest.raises(ValueError):
        find_motif(g, [("a", "e1", "b"), ("c", "e2", "d")])


def simple_path_ends(edges, seed, hops):
    out = defaultdict(set)
    links = set(edges)

    def walk(path):
        if len(path) > hops:
            return
        for a, b in links:
            if a == path[-1] and b not in path:
                out[len(path)].add(b)
                walk(path + [b])

    walk([seed])
    return {(d, v) for d, vs in out.items() for v in vs}


@pytest.mark.parametrize("seed", range(2))
def test_reach_forms_agree(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(9), rnd.randrange(9)) for _ in range(16)]
    g = make(spark, range(9), edges, "long")
    start = spark.createDataFrame([(edges[0][0],)], "seed long")
    for hops in (2, 3, 4):
        want = simple_path_ends(edges, edges[0][0], hops)
        got = {tuple(r) for r in traverse.reach_by_paths(g.edges, start, hops).collect()}
        assert got == want, hops
        near = as_dict(traverse.reach_by_distance(g.edges, start, hops).select("guest_id", "depth"))
        first = {}
        for d, v in sorted(want):
            first.setdefault(v, d)
        assert near == first


def test_path_counts_of_a_four_node_graph(spark):
    """A guest counts at every depth at which a simple path ends there."""
    both = [(1, 2), (1, 3), (2, 3), (3, 4)]
    g = make(spark, [1, 2, 3, 4], both + [(b, a) for a, b in both], "long")
    start = spark.createDataFrame([(1,)], "seed long")
    got = [tuple(r) for r in traverse.guests_per_depth(traverse.reach_by_paths(g.edges, start)).collect()]
    assert got == [(1, 2), (2, 3), (3, 1)]


@pytest.mark.parametrize("slice_rows", [5_000, 2])
def test_two_hop(spark, slice_rows):
    rnd = random.Random(8)
    edges = sorted({(rnd.randrange(12), rnd.randrange(12)) for _ in range(40)})
    g = make(spark, range(12), edges, "long")
    want = {(a, d): 2 for a, b in edges for c, d in edges if b == c and a != d}
    want |= {(a, b): 1 for a, b in edges if a != b}
    got = {(r[0], r[1]): r[2] for r in traverse.two_hop(g.edges, slice_rows=slice_rows).collect()}
    assert got == want
    seeds = spark.createDataFrame([(edges[0][0],)], "seed long")
    part = {(r[0], r[1]): r[2] for r in traverse.two_hop(g.edges, seeds, slice_rows).collect()}
    assert part == {k: v for k, v in want.items() if k[0] == edges[0][0]}


def dense_edges():
    """Two cliques that meet in one guest, a ring through both, and parallel and looping edges."""
    cliques = [(a, b) for group in (range(7), range(6, 13)) for a in group for b in group if a != b]
    return cliques + [(i, (i + 1) % 13) for i in range(13)] + [(3, 3), (12, 13), (13, 14), (14, 0), (0, 12)]


@pytest.mark.parametrize("hops", [5, 6])
def test_simple_paths_on_a_dense_graph(spark, hops, monkeypatch):
    edges, rows = dense_edges(), []
    kept = traverse.representatives
    monkeypatch.setattr(traverse, "representatives", lambda ways, left: rows.append(kept(ways, left)) or rows[-1])
    g = make(spark, range(15), edges, "long")
    got = {tuple(r) for r in traverse.reach_by_paths(g.edges, spark.createDataFrame([(0,)], "seed long"), hops).collect()}
    assert got == simple_path_ends(edges, 0, hops)
    for depth, level in enumerate(rows, 2):
        p, left = depth - 1, hops - depth
        assert level.groupBy("guest_id").count().agg(F.max("count")).first()[0] <= sum(p**j for j in range(left + 1))


@pytest.mark.parametrize("near_rows", [traverse.NEAR_ROWS, 6, 0])
def test_edges_are_exchanged_for_large_levels_only(spark, near_rows, monkeypatch):
    """A level counted to be small is broadcast to the edges, which are neither shuffled nor sorted; the result is the same."""
    plans, plain, edges = [], traverse.cut, dense_edges()

    def seen(df, name, *args, **options):
        if name in ("ways", "frontier"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name, *args, **options)

    monkeypatch.setattr(traverse, "cut", seen)
    g, start = make(spark, range(15), edges, "long"), spark.createDataFrame([(0,)], "seed long")
    want = simple_path_ends(edges, 0, 4)
    assert {tuple(r) for r in traverse.reach_by_paths(g.edges, start, 4, near_rows=near_rows).collect()} == want
    first = {v: min(d for d, w in want if w == v) for _, v in want}
    near = traverse.reach_by_distance(g.edges, start, 4, near_rows=near_rows)
    assert as_dict(near.select("guest_id", "depth")) == first
    joins = [len(re.findall(r"SortMergeJoin \[src", plan)) for plan in plans]
    # Depths 2 and 3 of the paths, 1 to 4 of the distances; the seed of the distances is one row.
    exchanged = {traverse.NEAR_ROWS: [0] * 6, 0: [1, 1, 0, 1, 1, 1]}
    assert len(joins) == 6 and (joins == exchanged[near_rows] if near_rows in exchanged else 0 < sum(joins) < 5)


@pytest.mark.parametrize("seed", range(3))
def test_kept_sets_stand_for_all(spark, seed):
    """Whichever few guests are to be avoided: if a set avoids them, a kept one does."""
    rnd = random.Random(seed)
    sets = {(g, tuple(sorted(rnd.sample(range(8), 3)))) for g in range(4) for _ in range(25)}
    ways = spark.createDataFrame([(g, list(s)) for g, s in sets], "guest_id long, via array<long>")
    for left in (0, 1, 2, 3):
        kept = {(r.guest_id, tuple(r.via)) for r in traverse.representatives(ways, left).collect()}
        assert kept <= sets
        for g in range(4):
            for avoid in itertools.combinations(range(8), left):
                free = lambda of: any(h == g and not set(s) & set(avoid) for h, s in of)  # noqa: B023, E731
                assert free(kept) == free(sets)


def pairs_by_distance(edges, hops):
    out = {}
    for v in {x for e in edges for x in e}:
        seen = frontier = {v}
        for d in range(1, hops + 1):
            frontier = {b for a, b in edges if a in frontier} - seen
            seen = seen | frontier
            out[d] = out.get(d, 0) + len(frontier)
    return {d: n for d, n in out.items() if n}


@pytest.mark.parametrize("lg_k", [6, 8, 12])
def test_sketched_histogram_is_within_its_error(spark, lg_k):
    rnd = random.Random(lg_k)
    edges = [(rnd.randrange(250), rnd.randrange(250)) for _ in range(700)] + [(1, 1), (1, 2), (1, 2)]
    g = make(spark, range(250), edges, "long")
    want = pairs_by_distance(edges, 4)
    got = as_dict(traverse.sketched_hop_histogram(g.edges, 4, lg_k))
    upto = 250
    for d, n in want.items():
        upto += n
        assert abs(got[d] - n) <= 3 * traverse.sketch_error(lg_k) * upto
    if lg_k == 12:
        assert got == want
    exact = as_dict(traverse.hop_histogram(traverse.two_hop(g.edges)))
    assert exact == {d: want[d] for d in (1, 2)}


def test_sketched_histogram_of_no_edges(spark):
    g = make(spark, [1], [], "long")
    assert traverse.sketched_hop_histogram(g.edges).count() == 0


def test_sketched_histogram_lists_no_pairs(spark):
    """A star of 300 guests has 90,000 pairs two hops apart; no table of the search has more rows than its edges."""
    edges = [(0, i) for i in range(1, 301)] + [(i, 0) for i in range(1, 301)]
    sizes = []
    state = traverse.LoopState.advance

    class Counted(traverse.LoopState):
        def advance(self, df, name=""):
            written = state(self, df, name)
            sizes.append(written.count())
            return written

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(traverse, "LoopState", Counted)
        got = as_dict(traverse.sketched_hop_histogram(make(spark, range(301), edges, "long").edges, 2))
    assert got == {1: 600, 2: 300 * 299} and max(sizes) == 301


@pytest.mark.parametrize("seed", range(2))
def test_components_of_batches_equal_a_full_run(spark, seed):
    """Vertices, edges, loops and repeats in three batches, ends before their vertices; untouched names stay."""
    rnd = random.Random(seed)
    vertices = list(range(60))
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(3, 3), (1, 2), (1, 2)]
    labels = spark.createDataFrame([], "id long, component long")
    so_far = set()
    for batch in range(3):
        g = make(spark, vertices[batch::3], edges[batch::3], "long")
        before = as_dict(labels)
        labels = extended_components(labels, g.vertices, g.edges)
        so_far |= set(vertices[batch::3]) | {x for e in edges[batch::3] for x in e}
        want = union_find(sorted(so_far), [e for b in range(batch + 1) for e in edges[b::3]])
        got = as_dict(labels)
        assert got == want and all(got[v] <= c for v, c in before.items())
    assert as_dict(extended_components(labels, g.vertices.limit(0), g.edges.limit(0))) == got


def test_edge_side_of_a_round_is_not_shuffled(spark):
    """The join of edges and state shuffles the state only; released edges leave no table."""
    from kinweave.operators.spread_edges import SpreadEdges

    g = make(spark, range(40), [(i % 7, i) for i in range(200)], "long")
    for slice_edges in (1_000, 5):
        layout = SpreadEdges(g.edges, g.edges.groupBy("src").agg(F.count("dst").alias("out_degree")), slice_edges)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            met = layout.meet(g.vertices)
            plan = met._jdf.queryExecution().executedPlan().toString()
            join = plan[plan.index("SortMergeJoin") :]
            edge_side = join[: join.index("spread_edges")]
            assert "Exchange" not in edge_side and "Bucketed: true" in plan
            assert met.count() == 200
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        layout.release()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("spread_edges")]


def test_parallel_edges_of_a_hub_are_spread(spark):
    from kinweave.operators.spread_edges import SpreadEdges

    g = make(spark, range(2), [(0, 1)] * 400, "long")
    layout = SpreadEdges(g.edges.repartition(4), g.edges.groupBy("src").agg(F.count("dst").alias("out_degree")), 50)
    sizes = [r["count"] for r in layout._edges.groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 400 and layout.meet(g.vertices).count() == 400
    layout.release()


def test_tables_that_grow_do_not_pass_through_the_driver(spark):
    """Joins of such tables have no broadcast, however small their files are."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    g = Graph.from_edges(spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "src string, dst string"))
    cohorts = connected_components(g.vertices, g.edges)
    assert sorted(r.component for r in cohorts.collect()) == ["a", "a", "a", "d", "d"]
    spent = spark.createDataFrame([("r1", 2.0)], "record_id string, amount_gbp double")
    resolved = spark.createDataFrame([("r1", "a")], "record_id string, golden_id string")
    spend = value.cohort_spend(spent, resolved, cohorts.withColumnRenamed("component", "cohort_id"))
    for df in (cohorts, spend, centrality.centrality(g, centrality.pagerank(g, iterations=1)), relations.members_golden(
        spark.createDataFrame([("p1", "r1", "b1")], "party_id string, record_id string, booking_id string"), resolved
    )):
        assert "Broadcast" not in plan(df)


def test_tasks_of_two_hops_follow_the_paths(spark):
    """A star has few edges and many paths: 1,640 of two edges here."""
    edges = spark.createDataFrame([e for i in range(40) for e in (("hub", f"v{i}"), (f"v{i}", "hub"))], "src string, dst string")
    for slice_rows in (10, 5_000):
        found = traverse.two_hop(edges, slice_rows=slice_rows, task_paths=100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"hashpartitioning\(.*, 17\), REPARTITION_BY_NUM", plan)) == 3
        hops = {(r.guest_id, r.reachable_guest): r.hops for r in found.collect()}
        near = {(a, b) for i in range(40) for a, b in (("hub", f"v{i}"), (f"v{i}", "hub"))}
        assert hops == {**{(f"v{i}", f"v{j}"): 2 for i in range(40) for j in range(40) if i != j}, **{p: 1 for p in near}}


def test_batches_of_links_are_derived_once(spark, monkeypatch):
    """Every batch scans its own folder of the dealt guests and links; none derives them anew."""
    from kinweave.plans import registry

    plans, plain = [], extended_components

    def seen(labels, vertices, edges):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (vertices, edges))
        return plain(labels, vertices, edges)

    monkeypatch.setattr(registry, "extended_components", seen)
    sf = "/root/testdata/sf0.001"
    got = registry.registered()["cohorts_in_batches"](spark, sf)
    want = registry.registered()["cohorts"](spark, sf)
    assert as_dict(got) == as_dict(want) and len(plans) == 6
    assert all("Join" not in p and "Exchange" not in p and re.search(r"PartitionFilters: \[.*batch.* = ", p) for p in plans), plans
