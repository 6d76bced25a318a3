"""The stage tables of one run, each derived once from the ones before it and written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinweave.operators import centrality, relations, traverse
from kinweave.operators.components import connected_components
from kinweave.operators.graph import Graph, edges_of
from kinweave.operators.resolve import blocking, clustering, comparisons, model, scoring
from kinweave.plans import value
from kinweave.session import cut, exchanged
from kinweave.sources import guests

PASS_METHOD = "md5"


class Stages:
    """``stages["guest_cohorts"]`` is the scan of that stage's table, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}
        self._training: model.Training | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            partition_by = ("predicate",) if name == "gold_triplets" else ()
            self._made[name] = exchanged(cut(_STAGES[name](self), name, partition_by))
        return self._made[name]

    def source(self, name: str) -> DataFrame:
        return guests.derive(self.spark, self.sf_dir, name)

    @property
    def records(self) -> DataFrame:
        return blocking.comparison_input(self["guests_raw"])

    def relation_graph(self) -> Graph:
        """All golden guests with attended and paid edges, solo guests included."""
        return Graph(self["guests_resolved"].select(F.col("golden_id").alias("id")).distinct(), self["edges"])

    def visit_graph(self) -> Graph:
        """Ends of VISITED_WITH edges only."""
        return Graph.from_edges(edges_of(self["gold_triplets"], "VISITED_WITH"))

    def training(self) -> model.Training:
        if self._training is None:
            self._training = model.train(self.records, levels=self["u_levels"])
        return self._training

    def most_connected_guest(self) -> DataFrame:
        return traverse.top_vertex(relations.companion_degree(self["gold_triplets"]))


def _components(s: Stages) -> DataFrame:
    found = connected_components(
        s["guests_resolved"].select(F.col("golden_id").alias("id")).distinct(), s["party_links"]
    )
    return found.withColumnRenamed("component", "cohort_id")


def _edges(s: Stages) -> DataFrame:
    payers = relations.payers_golden(s["bookings"], s["guests_resolved"])
    return relations.all_edges(
        relations.attended_edges(s["members_golden"]), relations.paid_edges(payers, s["members_golden"])
    )


def _triplets(s: Stages) -> DataFrame:
    attended, paid = (
        s["edges"].where(F.col("relationship") == kind) for kind in ("attended_with", "paid_for")
    )
    return relations.triplets(s["guests_resolved"], attended, paid)


_STAGES: dict[str, Callable[[Stages], DataFrame]] = {
    "guests_raw": lambda s: s.source("guests_raw"),
    "bookings": lambda s: s.source("bookings"),
    "party_members": lambda s: s.source("party_members"),
    "transactions": lambda s: s.source("transactions"),
    "guests_resolved": lambda s: clustering.resolve(s.records, model.GIVEN_MODEL),
    "members_golden": lambda s: relations.members_golden(s["party_members"], s["guests_resolved"]),
    "party_links": lambda s: relations.party_links(
        s["members_golden"], relations.payers_golden(s["bookings"], s["guests_resolved"])
    ),
    "edges": _edges,
    "guest_cohorts": _components,
    "guest_influence": lambda s: centrality.pagerank(s.relation_graph()),
    "cohort_spend": lambda s: value.cohort_spend(
        s["transactions"], s["guests_resolved"], s["guest_cohorts"], method=PASS_METHOD
    ),
    "gold_triplets": _triplets,
    "guest_names": lambda s: relations.guest_names(s["guests_resolved"], s["guests_raw"]),
    "guest_2hop": lambda s: traverse.two_hop(edges_of(s["gold_triplets"], "VISITED_WITH")),
    "guest_communities": lambda s: centrality.label_propagation(s.visit_graph()),
    "visit_influence": lambda s: centrality.pagerank(s.visit_graph()),
    "u_levels": lambda s: model.estimate_u(s.records, comparisons.guest_comparisons()),
    "scored_pairs": lambda s: scoring.score_pairs(s.records, model.GIVEN_MODEL),
    "resolved_learned": lambda s: clustering.resolve(s.records, s.training().model),
}

_open: dict[tuple[str, str], tuple[tuple[tuple[str, int, int], ...], Stages]] = {}


def file_states(df: DataFrame) -> list[tuple[str, int, int]]:
    """Name, length and time of change of each file of a scan."""
    spark, out = df.sparkSession, []
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        state = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((name, state.getLen(), state.getModificationTime()))
    return out


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """The stage tables of this application over one input folder, made anew when its files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    files = tuple(sorted(x for t in ("customer", "orders") for x in file_states(spark.read.parquet(f"{key[1]}/{t}.parquet"))))
    if key not in _open or _open[key][0] != files:
        _open[key] = (files, Stages(spark, key[1]))
    return _open[key][1]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Drop the stage tables of an input folder, so that they are made anew."""
    _open.pop((spark.sparkContext.applicationId, sf_dir.rstrip("/")), None)
