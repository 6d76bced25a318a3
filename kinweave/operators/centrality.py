"""PageRank, label propagation and the centrality table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinweave.operators.graph import Graph, degrees
from kinweave.operators.spread_edges import SLICE_EDGES, SpreadEdges
from kinweave.resume import Rounds
from kinweave.session import LoopState, cut, exchanged


def pagerank(
    graph: Graph,
    reset: float = 0.15,
    iterations: int = 10,
    normalized: bool = True,
    cut_every: int = 5,
    slice_edges: int = SLICE_EDGES,
    kept: Rounds | None = None,
) -> DataFrame:
    """``(id, pagerank)`` after a fixed number of rounds from rank 1.

    A round is ``reset + (1 - reset) * sum(rank / out_degree)`` over incoming edges, parallel edges each
    counted. ``normalized`` scales the ranks to sum to the number of vertices, which matters when
    vertices without outgoing edges lose rank. With ``kept`` the ranks lie in a lasting folder each time they are cut, and
    rounds done by a driver that ended are not done again.
    """
    vertices = cut(graph.vertices.select("id"), "vertices")
    links = graph.edges.select("src", "dst")
    out_degree = cut(links.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")), "out-degree")
    weighted = links.join(exchanged(out_degree), "src").select("src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("share"))
    layout = SpreadEdges(weighted, out_degree, slice_edges)
    state = LoopState(graph.edges.sparkSession, "pagerank")

    silent = vertices.select("id", F.lit(0.0).alias("gain"))
    start = kept.step if kept else 0
    ranks = kept.tables()["ranks"] if start else vertices.select("id", F.lit(1.0).alias("pagerank"))
    for done in range(start + 1, iterations + 1):
        gains = layout.meet(ranks).select(F.col("dst").alias("id"), (F.col("pagerank") * F.col("share")).alias("gain"))
        ranks = gains.unionByName(silent).groupBy("id").agg(
            (F.lit(reset) + F.lit(1 - reset) * F.sum("gain")).alias("pagerank")
        )
        if done % cut_every == 0 or done == iterations:
            ranks = kept.finish(done, ranks=ranks)["ranks"] if kept else state.advance(ranks)
    layout.release()
    if normalized:
        total = ranks.agg((F.count(F.lit(1)) / F.sum("pagerank")).alias("scale"))
        ranks = ranks.select("id", (F.col("pagerank") * total.scalar()).alias("pagerank"))
    return ranks


def label_propagation(
    graph: Graph, rounds: int = 5, cut_every: int = 5, slice_edges: int = SLICE_EDGES, kept: Rounds | None = None
) -> DataFrame:
    """``(id, label)`` after a fixed number of rounds of adopting the most frequent neighbour label.

    Labels travel both ways along every edge. Of equally frequent labels the smallest wins. A vertex that
    hears nothing keeps its own id. ``kept`` as for ``pagerank``.
    """
    links = graph.edges.select("src", "dst")
    both = links.select(
        F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e")
    ).groupBy("e.src", "e.dst").agg(F.count(F.lit(1)).alias("weight"))
    both = cut(both, "neighbours")
    layout = SpreadEdges(both, both.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")), slice_edges)
    vertices = cut(graph.vertices.select("id"), "vertices")
    state = LoopState(graph.edges.sparkSession, "labels")

    silent = vertices.select("id", F.col("id").alias("label"), F.lit(0).cast("long").alias("votes"))
    start = kept.step if kept else 0
    labels = kept.tables()["labels"] if start else vertices.select("id", F.col("id").alias("label"))
    for done in range(start + 1, rounds + 1):
        votes = layout.meet(labels).groupBy(F.col("dst").alias("id"), "label").agg(F.sum("weight").alias("votes"))
        labels = votes.unionByName(silent).groupBy("id").agg(
            F.min(F.struct((-F.col("votes")).alias("rank"), "label")).alias("best")
        ).select("id", F.col("best.label").alias("label"))
        if done % cut_every == 0 or done == rounds:
            labels = kept.finish(done, labels=labels)["labels"] if kept else state.advance(labels)
    layout.release()
    return vertices.join(exchanged(labels), "id")


def centrality(graph: Graph, ranks: DataFrame) -> DataFrame:
    """Degree and PageRank per guest, most influential first."""
    return degrees(graph.edges).join(exchanged(ranks), "id").orderBy(F.desc("pagerank"), "id")
