"""Bounded multi-hop reachability over directed edges."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Observation, Window as W, functions as F

from kinweave.operators.skew import SLICE_ROWS, sliced_join
from kinweave.session import LoopState, cut, exchanged, observed

# Paths of two edges that a task makes, or reduces to pairs, on average.
TASK_PATHS = 1_000_000
# Rows of a level up to which it is broadcast to the edges, which then are neither shuffled nor sorted.
NEAR_ROWS = 50_000


def top_vertex(degree: DataFrame, vertex: str = "guest_id") -> DataFrame:
    """The single vertex with the highest degree, smallest id first among equals."""
    return F.broadcast(degree.orderBy(F.desc("degree"), vertex).limit(1).select(F.col(vertex).alias("seed")))


def _level(rows: DataFrame, name: str, near_rows: int) -> tuple[DataFrame, DataFrame]:
    """The written level, and the same as the edges meet it: broadcast if counted to have at most ``near_rows`` rows."""
    seen = Observation()
    level = cut(rows.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return level, F.broadcast(level) if observed(seen, level, "n")[0] <= near_rows else exchanged(level)


def reach_by_paths(edges: DataFrame, seed: DataFrame, max_hops: int = 3, near_rows: int = NEAR_ROWS) -> DataFrame:
    """``(depth, guest_id)``: guests at the end of some simple path of that length from the seed.

    A guest appears once per depth at which such a path exists. No level carries paths. Of all sets of guests
    on the way to a guest, a level keeps a few that represent the others: if some path can be continued by the
    steps that are left, one through a kept set can. Their number depends on ``max_hops`` alone, so a level's rows
    are linear in the guests it reaches, and the candidates of the next in its edges. The edges are exchanged for levels of more
    than ``near_rows`` rows only.
    """
    onto = (F.col("dst") != F.col("src")) & (F.col("dst") != seed.select("seed").scalar())
    links = cut(edges.select("src", "dst").where(onto).distinct(), "links")
    # The seed is one row, so the join filters the scan.
    level, met = _level(links.join(seed, F.col("src") == F.col("seed")).select(
        F.col("dst").alias("guest_id"), F.array().cast(f"array<{_type(links, 'src')}>").alias("via")
    ), "hop", near_rows)
    out = level.select(F.lit(1).alias("depth"), "guest_id")
    for depth in range(2, max_hops + 1):
        onward = links.join(met, F.col("src") == F.col("guest_id")).where(~F.array_contains("via", F.col("dst")))
        if depth == max_hops:
            return out.union(onward.select(F.lit(depth).alias("depth"), F.col("dst").alias("guest_id")).distinct())
        onward = cut(onward.select(
            F.col("dst").alias("guest_id"), F.array_sort(F.array_append("via", F.col("src"))).alias("via")
        ).distinct(), "ways")
        level, met = _level(representatives(onward, max_hops - depth), "hop", near_rows)
        out = out.union(level.select(F.lit(depth).alias("depth"), "guest_id").distinct())
    return out


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def representatives(ways: DataFrame, left: int) -> DataFrame:
    """For each guest a few of its sets ``(guest_id, via)`` that stand for all: whichever ``left`` guests are to be
    avoided, if some set avoids them, a kept one does.

    The smallest set is kept; each of its members may be among those to be avoided, so for each the smallest set
    without it is kept, and so on, ``left`` times. Sets of ``p`` members leave at most ``1 + p + ... + p ** left``
    per guest. ``ways`` is a written table of distinct sorted sets, read once per step and pre-aggregated.
    """
    kept = cut(ways.groupBy("guest_id").agg(F.min("via").alias("via")), "kept-ways")
    found, latest = kept, kept.withColumn("without", F.slice("via", 1, 0))
    for _ in range(left):
        avoided = F.array_sort(F.array_append("without", F.col("member")))
        # The same guests to be avoided may come in another order, which costs a comparison and changes nothing.
        nodes = latest.select("guest_id", "without", F.explode("via").alias("member")).select(
            F.col("guest_id").alias("at"), avoided.alias("without")
        )
        latest = cut(
            ways.join(exchanged(nodes), (F.col("guest_id") == F.col("at")) & ~F.arrays_overlap("via", "without"))
            .groupBy("guest_id", "without").agg(F.min("via").alias("via")), "kept-ways",
        )
        found = found.union(latest.select("guest_id", "via"))
    return found.distinct()


def reach_by_distance(edges: DataFrame, seed: DataFrame, max_hops: int = 3, near_rows: int = NEAR_ROWS) -> DataFrame:
    """``(depth, guest_id)``: each guest once, at its distance from the seed. ``near_rows`` as for ``reach_by_paths``."""
    links = edges.select("src", "dst")
    seen = cut(seed.select(F.lit(0).alias("depth"), F.col("seed").alias("guest_id")), "visited")
    met = F.broadcast(seen)
    for depth in range(1, max_hops + 1):
        frontier, met = _level(
            links.join(met, F.col("src") == F.col("guest_id"))
            .select(F.lit(depth).alias("depth"), F.col("dst").alias("guest_id")).distinct()
            .join(exchanged(seen.select("guest_id")), "guest_id", "left_anti").select("depth", "guest_id"),
            "frontier", near_rows,
        )
        seen = seen.union(frontier)
    return seen.where(F.col("depth") > 0)


def guests_per_depth(reach: DataFrame) -> DataFrame:
    return reach.groupBy("depth").agg(F.count(F.lit(1)).alias("guests_reached")).orderBy("depth")


def _paths(start: DataFrame, links: DataFrame) -> int:
    """Number of paths of an edge of ``start`` and one of ``links``."""
    into = start.groupBy("mid").agg(F.count(F.lit(1)).alias("n_in"))
    out = links.groupBy("src").agg(F.count(F.lit(1)).alias("n_out"))
    through = into.join(exchanged(out), F.col("mid") == F.col("src")).select((F.col("n_in") * F.col("n_out")).alias("paths"))
    seen = Observation()
    through = cut(through.observe(seen, F.coalesce(F.sum("paths"), F.lit(0)).alias("paths")), "paths")
    return observed(seen, through, "paths")[0]


def two_hop(
    edges: DataFrame, seeds: DataFrame | None = None, slice_rows: int = SLICE_ROWS, task_paths: int = TASK_PATHS
) -> DataFrame:
    """Least number of hops, one or two, from each guest to every other guest it reaches.

    ``seeds(seed)`` restricts the starting guests before the join. Parallel edges change nothing. There are many more paths
    than edges, so they are counted first, and as many tasks make and reduce them as leave each about ``task_paths``.
    """
    links = edges.select("src", "dst")
    start = links if seeds is None else links.join(seeds, F.col("src") == F.col("seed"), "left_semi")
    start = start.select(F.col("src").alias("guest_id"), F.col("dst").alias("mid"))
    tasks = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(_paths(start, links) / task_paths))
    further = sliced_join(
        start, links.select("src", F.col("dst").alias("reachable_guest")), ["mid"], ["src"],
        F.col("guest_id") != F.col("reachable_guest"), slice_rows=slice_rows, partitions=tasks,
    ).select("guest_id", "reachable_guest", F.lit(2).alias("hops"))
    direct = start.where(F.col("guest_id") != F.col("mid")).select(
        "guest_id", F.col("mid").alias("reachable_guest"), F.lit(1).alias("hops")
    )
    reached = direct.unionByName(further).repartition(tasks, "guest_id", "reachable_guest")
    return reached.groupBy("guest_id", "reachable_guest").agg(F.min("hops").alias("hops"))


def hop_histogram(hops: DataFrame) -> DataFrame:
    return hops.groupBy("hops").agg(F.count(F.lit(1)).alias("pairs")).orderBy("hops")


def sketch_error(lg_k: int) -> float:
    """The relative standard error of a ball's size, as estimated from a sketch of ``2 ** lg_k`` registers."""
    return 1.04 / 2 ** (lg_k / 2)


def sketched_hop_histogram(edges: DataFrame, max_hops: int = 2, lg_k: int = 12) -> DataFrame:
    """``(hops, pairs)``: about how many ordered pairs of different guests are so many hops apart, without listing any.

    Every vertex has a sketch of the distinct vertices within reach, at first of itself; a round merges into it the
    sketches of those its edges lead to, so a round costs one message per edge, whatever the number of pairs. Summed over the
    vertices, the growth of the estimates is the number of pairs at that distance. An estimate is off by a
    standard error of ``sketch_error(lg_k)`` of a ball; a depth's pairs by at most about three times that share of all pairs up
    to that depth. Balls of few vertices against the registers (below ``2 ** (lg_k - 4)``) are practically exact.
    """
    links = cut(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(), "links")
    state = LoopState(edges.sparkSession, "balls")
    vertices = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    balls = state.advance(vertices.groupBy("id").agg(F.hll_sketch_agg("id", F.lit(lg_k)).alias("ball")))
    within = lambda hops, df: df.agg(F.lit(hops).alias("hops"), F.sum(F.hll_sketch_estimate("ball")).alias("within"))
    totals = [cut(within(0, balls), "within")]
    for hops in range(1, max_hops + 1):
        heard = links.join(balls.withColumnRenamed("id", "dst"), "dst").select(F.col("src").alias("id"), "ball")
        balls = state.advance(heard.unionByName(balls).groupBy("id").agg(F.hll_union_agg("ball").alias("ball")))
        totals.append(cut(within(hops, balls), "within"))
    sums = totals[0]
    for total in totals[1:]:
        sums = sums.unionByName(total)
    grown = F.col("within") - F.lag("within").over(W.orderBy("hops"))  # one row per depth
    return sums.select("hops", grown.alias("pairs")).where("pairs > 0").orderBy("hops")
