"""Loops that are taken up again, and tables that are replaced as a whole."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinweave.operators import centrality
from kinweave.operators.components import connected_components
from kinweave.resume import Rounds
from kinweave.sources import catalog, versions
from test_graph import GRAPHS, as_dict, make, together


@pytest.fixture
def schema(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS lasting_test LOCATION '{tmp_path}/lasting_test'")
    yield "lasting_test"
    spark.sql("DROP SCHEMA lasting_test CASCADE")


def test_components_go_on_from_the_last_whole_round(spark, tmp_path):
    vertices, edges = together(["shuffled_path", "star", "self_loop", "isolated", "k4"])
    graph = make(spark, vertices, edges)
    want = as_dict(connected_components(graph.vertices, graph.edges))
    folder = f"{tmp_path}/rounds"
    with pytest.raises(RuntimeError):
        connected_components(graph.vertices, graph.edges, 1, Rounds(spark, folder, "c"))
    taken_up = Rounds(spark, folder, "c")
    done = taken_up.done
    assert done >= 2
    # What a driver was writing when it ended is no round; neither is a manifest that was not renamed.
    broken = Path(folder) / f"round-{done + 1:06d}" / "pairs"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"half")
    (Path(folder) / f"_manifest-{done + 1:06d}.json.draft").write_text("{")
    nothing = graph.edges.limit(0)  # the edges are in the folder
    assert as_dict(connected_components(graph.vertices, nothing, rounds=Rounds(spark, folder, "c"))) == want
    assert len([p for p in Path(folder).iterdir() if p.name.startswith("round-")]) <= 2
    with pytest.raises(ValueError):
        Rounds(spark, folder, "another")
    Rounds(spark, folder, "c").clear()
    assert Rounds(spark, folder, "c").done == 0 and Rounds(spark, folder, "another").tables() == {}


@pytest.mark.parametrize("name", ["star", "empty", "two_cycle"])
def test_ranks_and_labels_go_on(spark, tmp_path, name):
    graph = make(spark, *GRAPHS[name])
    kept = lambda what: Rounds(spark, f"{tmp_path}/{what}", what)
    centrality.pagerank(graph, iterations=3, cut_every=2, kept=kept("ranks")).count()
    assert kept("ranks").step == 3
    found = as_dict(centrality.pagerank(graph, iterations=6, cut_every=2, kept=kept("ranks")))
    assert found == pytest.approx(as_dict(centrality.pagerank(graph, iterations=6)))
    assert kept("ranks").step == 6
    centrality.label_propagation(graph, rounds=1, cut_every=1, kept=kept("labels")).count()
    assert as_dict(centrality.label_propagation(graph, rounds=4, kept=kept("labels"))) == as_dict(centrality.label_propagation(graph, rounds=4))


def test_a_reader_sees_one_version(spark, schema, monkeypatch):
    name = f"{schema}.report"
    ids = lambda df: sorted(r.id for r in df.collect())
    versions.replace_table(spark.range(3), name, "First.", {"id": "A number."})
    assert catalog.comments(spark, name) == ("First.", {"id": "A number."})
    early, seen, move = spark.table(name), [], catalog.create_view

    def watched(*args):
        seen.append((ids(spark.table(name)), ids(early)))
        return move(*args)

    monkeypatch.setattr(catalog, "create_view", watched)
    late = versions.replace_table(spark.table(name).select(F.col("id") + 10, F.lit("x").alias("more")).toDF("id", "more"), name)
    assert seen == [([0, 1, 2], [0, 1, 2])] and ids(early) == [0, 1, 2] and ids(late) == ids(spark.table(name)) == [10, 11, 12]
    monkeypatch.undo()
    assert spark.table(name).columns == ["id", "more"]
    versions.replace_table(spark.range(1), name)
    assert ids(late) == [10, 11, 12] and len(versions.versions(spark, name)) == 2
    versions.replace_table(spark.range(0), name, keep=0)
    assert spark.table(name).count() == 0 and len(versions.versions(spark, name)) == 1
    versions.drop_versions(spark, name)
    assert not spark.catalog.tableExists(name) and versions.versions(spark, name) == []


def test_a_failed_write_leaves_the_old_version(spark, schema, tmp_path):
    name = f"{schema}.report"
    versions.replace_table(spark.range(3), name)
    before = sorted(p.name for p in (tmp_path / schema).iterdir())
    with pytest.raises(Exception, match="broken row"):
        versions.replace_table(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id")), name)
    assert spark.table(name).count() == 3 and sorted(p.name for p in (tmp_path / schema).iterdir()) == before
    # Names that only begin alike are other tables.
    versions.replace_table(spark.range(5), f"{name}__v1")
    assert len(versions.versions(spark, name)) == 1
    catalog.save_table(spark.range(2), f"{schema}.plain")
    with pytest.raises(ValueError):
        versions.replace_table(spark.range(1), f"{schema}.plain")
