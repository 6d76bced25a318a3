"""Property graph as two DataFrames, with degree, triangle and pattern operators."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.operators.skew import SLICE_ROWS, sliced_join
from kinweave.session import bucketed, cut, exchanged

# Edges in a cell of coloured vertices.
CELL_EDGES = 500_000


@dataclass(frozen=True)
class Graph:
    """``vertices(id, ...)`` and ``edges(src, dst, ...)``."""

    vertices: DataFrame
    edges: DataFrame

    @staticmethod
    def from_edges(edges: DataFrame) -> "Graph":
        """Graph whose vertices are the edge ends, so isolated vertices are absent."""
        return Graph(vertices_of(edges), edges)

    def size(self) -> DataFrame:
        """One row with the number of vertices and edges."""
        parts = self.vertices.agg(F.count(F.lit(1)).alias("vertices"), F.lit(0).cast("long").alias("edges")).union(
            self.edges.agg(F.lit(0).cast("long").alias("vertices"), F.count(F.lit(1)).alias("edges"))
        )
        return parts.agg(F.sum("vertices").alias("vertices"), F.sum("edges").alias("edges"))


def edges_of(edge_table: DataFrame, predicate: str) -> DataFrame:
    """``src, dst`` of one predicate of the edge table."""
    return edge_table.where(F.col("predicate") == predicate).selectExpr("subject_id AS src", "object_id AS dst")


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """In-degree plus out-degree; vertices without edges are absent."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("degree")
    )


def _oriented(graph: Graph) -> tuple[DataFrame, DataFrame]:
    """The undirected edges once, ``src`` the smaller id, and ``(u, v)`` from the end with the lower degree to the other."""
    pairs = cut(
        graph.edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct(),
        "pairs",
    )
    degree = exchanged(cut(degrees(pairs), "degrees"))
    ranked = pairs.join(
        degree.select(F.col("id").alias("src"), F.col("degree").alias("src_degree")), "src"
    ).join(degree.select(F.col("id").alias("dst"), F.col("degree").alias("dst_degree")), "dst")
    low, high = F.struct("src_degree", "src"), F.struct("dst_degree", "dst")
    oriented = cut(
        ranked.select(
            F.when(low < high, F.col("src")).otherwise(F.col("dst")).alias("u"),
            F.when(low < high, F.col("dst")).otherwise(F.col("src")).alias("v"),
        ),
        "oriented",
    )
    return pairs, oriented


def triangle_count(graph: Graph, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Triangles through each vertex, direction and parallel edges ignored, zero where there is none.

    Every undirected edge is pointed from the end with the lower degree to the other, which bounds the
    edges leaving a vertex by the square root of twice the edge count, hubs included.
    """
    pairs, oriented = _oriented(graph)
    wedges = sliced_join(
        oriented.select("u", "v"),
        oriented.select(F.col("u").alias("u2"), F.col("v").alias("w")),
        ["u"], ["u2"], F.col("v") < F.col("w"), same_counts=True, slice_rows=slice_rows,
    ).select("u", "v", "w")
    closing = exchanged(pairs).select(F.col("src").alias("v"), F.col("dst").alias("w"))
    return _per_vertex(graph, wedges.join(closing, ["v", "w"]))


def _per_vertex(graph: Graph, triangles: DataFrame) -> DataFrame:
    corners = triangles.select(F.explode(F.array("u", "v", "w")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("count")
    )
    return graph.vertices.select("id").join(exchanged(corners), "id", "left").select(
        "id", F.coalesce("count", F.lit(0).cast("long")).alias("count")
    )


def coloured_triangle_count(graph: Graph, colours: int | None = None, cell_edges: int = CELL_EDGES) -> DataFrame:
    """``triangle_count`` without shuffling a wedge: what is shuffled is each edge once per colour.

    Vertices get colours by a hash. A cell is three colours, repeats allowed, and holds the edges whose ends have two of
    them, so each triangle lies whole in the cell of its corners' colours. The cells are the buckets of a written table,
    and both joins run inside them. By default there are as many colours as leave about ``cell_edges`` edges in a cell; the
    edges of a hub spread over the colours of their other ends. The joins sort and spill, a cell need not fit into memory.
    """
    spark = graph.edges.sparkSession
    _, oriented = _oriented(graph)
    n = oriented.count()
    colours = colours or max(1, ceil(sqrt(6 * n / cell_edges)))
    cells = colours * (colours + 1) * (colours + 2) // 6

    def colour(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(colours))

    def cell(a: Column, b: Column, c: Column) -> Column:
        three = F.array_sort(F.array(a, b, c))
        return (three[0] * colours + three[1]) * colours + three[2]

    third = F.sequence(F.lit(0).cast("long"), F.lit(colours - 1).cast("long"))
    copies = oriented.select(
        F.explode(F.transform(third, lambda x: cell(colour("u"), colour("v"), x))).alias("cell"), "u", "v"
    )
    buckets = min(cells, max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(n * colours / cell_edges)))
    held = bucketed(copies, "cells", ["cell"], buckets)
    other = held.select(F.col("cell").alias("cell2"), F.col("u").alias("u2"), F.col("v").alias("w"))
    closing = held.select(
        F.col("cell").alias("cell3"), F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi")
    )
    wedges = held.join(
        other, (F.col("cell") == F.col("cell2")) & (F.col("u") == F.col("u2")) & (F.col("v") < F.col("w"))
    ).where(F.col("cell") == cell(colour("u"), colour("v"), colour("w")))
    closed = wedges.join(
        closing, (F.col("cell") == F.col("cell3")) & (F.col("v") == F.col("lo")) & (F.col("w") == F.col("hi"))
    ).select("u", "v", "w")
    # Rows of a bucket have all their partners there, though a join has further keys.
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        return cut(_per_vertex(graph, closed), "triangles")
    finally:
        spark.conf.set(setting, before)


def find_motif(
    graph: Graph,
    pattern: list[tuple[str, str, str]],
    edge_filters: dict[str, Column] | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Instances of a chain or cycle of directed edges.

    ``pattern`` lists (source, edge, target) names; a repeated vertex name means the same vertex. The
    result has one struct column per vertex name (``id``) and per edge name (the edge's columns). Both
    ends of an edge must be vertices of the graph. ``edge_filters`` restrict single edges before joining.
    """
    ids = exchanged(cut(graph.vertices.select(F.col("id").alias("_vertex")).distinct(), "vertices"))
    filters = edge_filters or {}
    columns = graph.edges.columns

    known: set[str] = set()

    def step(src: str, edge: str, dst: str) -> DataFrame:
        rows = graph.edges.where(filters[edge]) if edge in filters else graph.edges
        if src == dst:
            rows = rows.where(F.col("src") == F.col("dst"))
        ends = {src: F.col("src"), dst: F.col("dst")}
        # A vertex met in an earlier edge has been checked there.
        for name, end in ends.items():
            if name not in known:
                rows = rows.join(ids, end == F.col("_vertex"), "left_semi")
                known.add(name)
        # Written, since the join counts its keys first and then reads it.
        return cut(rows.select(*[c.alias(f"v_{n}") for n, c in ends.items()], F.struct(*columns).alias(edge)), "step")

    found = step(*pattern[0])
    for i, part in enumerate(pattern[1:]):
        if i > 0:
            found = cut(found, "found")
        nxt = step(*part)
        shared = [c for c in nxt.columns if c.startswith("v_") and c in found.columns]
        if not shared:
            raise ValueError(f"pattern edge {part} shares no vertex with the edges before it")
        for c in shared:
            nxt = nxt.withColumnRenamed(c, f"{c}_next")
        found = sliced_join(found, nxt, shared, [f"{c}_next" for c in shared], slice_rows=slice_rows)
        found = found.drop(*[f"{c}_next" for c in shared])
    return found.select(
        *[F.struct(F.col(c).alias("id")).alias(c[2:]) if c.startswith("v_") else F.col(c) for c in found.columns]
    )
