"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from kinweave.resume import Rounds
from kinweave.session import LoopState, cut, discarded, exchanged, observed


def _lowest(pairs: DataFrame, state: LoopState) -> tuple[DataFrame, int]:
    """Smallest neighbour below each node, one row per node that has any, and the number of rows."""
    seen = Observation()
    low = pairs.groupBy("hi").agg(F.min("lo").alias("lowest")).observe(seen, F.count(F.lit(1)).alias("nodes"))
    low = state.advance(low, "lowest-")
    return low, observed(seen, low, "nodes")[0]


def _large_star(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """Tie every node to the smallest node below its smaller neighbour."""
    return pairs.join(low.withColumnRenamed("hi", "lo"), "lo", "left").select("hi", "lo", "lowest")


def _small_star(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    moved = pairs.join(low, "hi").where(F.col("lo") != F.col("lowest"))
    return (
        low.select("hi", F.col("lowest").alias("lo"))
        .unionByName(moved.select(F.col("lo").alias("hi"), F.col("lowest").alias("lo")))
        .distinct()
    )


def connected_components(
    vertices: DataFrame, edges: DataFrame, max_rounds: int = 100, rounds: Rounds | None = None
) -> DataFrame:
    """``(id, component)`` for every vertex; the component is named by its smallest member id.

    The edge list shrinks towards one star per component. A half round joins the edges to the table of
    smallest neighbours, one row per node; that table is written first, so the join is between two scans
    and the adaptive skew join can split the edges of a star's centre. The loop ends when every node hangs
    on one node that hangs on none, which the jobs that write the round's tables report on the way. With ``rounds`` a
    round's edges lie in a lasting folder, and a loop that ended early goes on from there.
    """
    state = LoopState(edges.sparkSession, "components")
    kept = (lambda df: exchanged(rounds.finish(pairs=df)["pairs"])) if rounds else state.advance
    pairs = exchanged(rounds.tables()["pairs"]) if rounds and rounds.done else kept(
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct()
    )
    for _ in range(max_rounds):
        low, nodes = _lowest(pairs, state)
        hanging = Observation()
        star = _large_star(pairs, low).observe(
            hanging, F.count(F.lit(1)).alias("pairs"), F.count("lowest").alias("deep")
        )
        # Duplicates that arise here go with those of the small star.
        pairs = state.advance(star.select("hi", F.coalesce("lowest", "lo").alias("lo")))
        if observed(hanging, pairs, "pairs", "deep") == [nodes, 0]:
            break
        pairs = kept(_small_star(pairs, _lowest(pairs, state)[0]))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return vertices.select("id").join(
        pairs.select(F.col("hi").alias("id"), "lo"), "id", "left"
    ).select("id", F.coalesce("lo", "id").alias("component"))


def extended_components(labels: DataFrame, vertices: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(id, component)`` after new vertices and edges have come to a labelled graph, as a run over everything would give it.

    New edges are looked up in the labels and become links between whole components; only the graph of the components they
    touch is contracted, and only members of those that take another's name are relabelled. Names are stable: a component keeps
    the smallest id it had until it is joined to one with a smaller, whose name it takes. An end of an edge that no vertex has come
    for yet is labelled too, so batches may come in any order. ``labels`` is a written table, at first an empty one.
    """
    spark = edges.sparkSession
    with discarded(spark):
        ends = edges.select("src", "dst").where(F.col("src") != F.col("dst"))
        named = ends.select(F.explode(F.array("src", "dst")).alias("id")).unionByName(vertices.select("id")).distinct()
        mine = exchanged(labels.select("id", "component"))
        of = exchanged(cut(named.join(mine, "id", "left").select("id", F.coalesce("component", "id").alias("component"), F.col("component").isNull().alias("new")), "named"))
        side = lambda name: of.select(F.col("id").alias(name), F.col("component").alias(f"{name}_in"))
        links = cut(
            ends.join(side("src"), "src").join(side("dst"), "dst").where(F.col("src_in") != F.col("dst_in"))
            .select(F.col("src_in").alias("src"), F.col("dst_in").alias("dst")).distinct(), "component-links",
        )
        touched = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        moved = cut(connected_components(touched, links, max_rounds).where(F.col("id") != F.col("component")).select(
            F.col("id").alias("component"), F.col("component").alias("joined")
        ), "moved")
        both = mine.unionByName(of.where("new").select("id", "component"))
        return cut(both.join(exchanged(moved), "component", "left").select("id", F.coalesce("joined", "component").alias("component")), "labels", outlives=True)
