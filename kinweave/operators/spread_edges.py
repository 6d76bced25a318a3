"""Edge layout that iterative vertex jobs join against in every round: a table bucketed by source."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from kinweave.operators.skew import BROADCAST_ROWS
from kinweave.session import bucketed, cut, exchanged, observed

# A vertex with more outgoing edges than this has them spread over several partitions.
SLICE_EDGES = 500_000
# Edges in a partition, on average, from which on more partitions are made.
EDGES_PER_PARTITION = 2_000_000


class SpreadEdges:
    """Edges written once as a table bucketed by source, so that a round shuffles vertex state and messages only.

    A lost executor loses none of it. The number of buckets follows the number of edges. The edges of a hub are cut into slices, parallel
    ones apart too, and its state row is copied to each slice. ``release`` drops the table.
    """

    def __init__(self, edges: DataFrame, out_degree: DataFrame, slice_edges: int = SLICE_EDGES):
        spark = edges.sparkSession
        seen, total = Observation(), Observation()
        self._hot = cut(
            out_degree.observe(total, F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"))
            .where(F.col("out_degree") > slice_edges)
            .select(F.col("src").alias("_hub"), F.ceil(F.col("out_degree") / slice_edges).cast("int").alias("_slices"))
            .observe(seen, F.count(F.lit(1)).alias("n")),
            "hubs",
        )
        n_hot = observed(seen, self._hot, "n")[0]
        n_edges = observed(total, self._hot, "edges")[0]
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_edges / EDGES_PER_PARTITION))
        self._keys = ["src"]
        if n_hot:
            if n_hot <= BROADCAST_ROWS:
                self._hot = F.broadcast(self._hot)
            slices = F.coalesce("_slices", F.lit(1))
            # Of many edges between two guests each goes where its place in the scan says.
            number = F.when(F.col("_slices").isNotNull(), F.monotonically_increasing_id())
            edges = edges.join(self._hot, F.col("src") == F.col("_hub"), "left").select(
                *edges.columns, F.pmod(F.xxhash64("dst", number), slices).cast("int").alias("_slice")
            )
            self._keys.append("_slice")
        self._forget: list[Callable[[], None]] = []
        self._edges = bucketed(edges, "spread-edges", self._keys, parts, owner=self._forget)

    def meet(self, state: DataFrame) -> DataFrame:
        """Join ``state(id, ...)`` to the edges that leave each vertex."""
        state = state.withColumnRenamed("id", "src")
        if "_slice" in self._keys:
            state = state.join(self._hot, F.col("src") == F.col("_hub"), "left").select(
                *state.columns,
                F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)).alias("_slice"),
            )
        return self._edges.join(exchanged(state), self._keys)

    def release(self) -> None:
        for forget in self._forget:
            forget()
        self._forget.clear()
