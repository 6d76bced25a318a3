import ast
import os
import re
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kinweave import session
from kinweave.operators import relations
from kinweave.operators.resolve.model import GIVEN_MODEL
from kinweave.plans import metrics, publish, value
from kinweave.sources import catalog, guests

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


@pytest.fixture
def schema(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS park_test LOCATION '{tmp_path}/park_test'")
    catalog.use_schema(spark, "park_test")
    yield "park_test"
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP SCHEMA park_test CASCADE")


def test_save_replaces_table_and_schema(spark, schema):
    catalog.save_table(spark.range(3), "t", "It's three\\numbers.", {"id": "A number."})
    assert spark.table("t").count() == 3
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t").collect()}
    assert described["Comment"] == "It's three\\numbers."
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE t").collect()}
    assert comments["id"] == "A number."
    again = catalog.save_table(spark.range(2).select(F.lit("a").alias("p"), "id"), "t", partition_by=("p",))
    assert sorted(again.columns) == ["id", "p"] and again.count() == 2


def test_rows_to_table_and_prerequisites(spark, schema):
    rows = [("b1", "p1", "r1", "park0", "2024-01-01")]
    catalog.save_table(catalog.table_from_rows(spark, rows, catalog.BOOKINGS_SCHEMA), "bookings")
    with pytest.raises(ValueError, match="guests_raw, guests_resolved, party_members, transactions"):
        catalog.require_tables(spark)
    catalog.require_tables(spark, ["bookings"])
    with pytest.raises(ValueError):
        catalog.use_schema(spark, " ")


def test_documented_view(spark, schema):
    spend = spark.createDataFrame(
        [("c1", value.WITH_PASS, 2, 10.0)], "cohort_id string, segment string, cohort_members long, total_spend_gbp double"
    )
    catalog.save_table(spend, "cohort_spend")
    query = value.COHORT_VALUE_QUERY.format(cohort_spend="cohort_spend")
    for _ in range(2):
        view = catalog.create_view(spark, "v_cohort_value", query, value.COHORT_VALUE_COMMENT, value.COHORT_VALUE_COLUMNS)
    assert [tuple(r) for r in view.collect()] == [("c1", value.WITH_PASS, 2, 10.0)]
    shown = {r.col_name: (r.data_type, r.comment) for r in spark.sql("DESCRIBE EXTENDED v_cohort_value").collect()}
    assert shown["segment"][1] == value.COHORT_VALUE_COLUMNS["segment"]
    assert shown["Comment"][0] == value.COHORT_VALUE_COMMENT
    catalog.create_view(spark, "v_plain", "SELECT 1 AS one")
    catalog.drop_view(spark, "v_plain")
    catalog.drop_view(spark, "v_plain")
    assert not spark.catalog.tableExists("v_plain")


def test_sources_use_every_input_row(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    raw = guests.derive(spark, SF, "guests_raw")
    assert raw.select("true_id").distinct().count() == customers
    assert raw.count() == raw.select("record_id").distinct().count()
    assert [f.dataType for f in raw.schema] == [f.dataType for f in catalog.GUESTS_RAW_SCHEMA]
    assert guests.derive(spark, SF, "transactions").count() == orders
    members, bookings = guests.derive(spark, SF, "party_members"), guests.derive(spark, SF, "bookings")
    assert members.select("party_id").distinct().count() == bookings.count()
    assert members.join(raw, "record_id", "left_anti").count() == 0
    assert bookings.join(raw, bookings.payer_record_id == raw.record_id, "left_anti").count() == 0


def test_loop_state_keeps_two_generations(spark):
    state = session.LoopState(spark, "gen")
    df = state.advance(spark.range(1))
    for _ in range(4):
        df = state.advance(df.select((F.col("id") + 1).alias("id")))
    assert df.first()["id"] == 4
    assert len(list(Path(state._path).iterdir())) == 2


def test_checkpoint_folder_comes_from_the_session():
    def fake(named=None, earlier=None, master="spark://m"):
        context = SimpleNamespace(getCheckpointDir=lambda: earlier, master=master)
        return SimpleNamespace(conf={"spark.checkpoint.dir": named} if named else {}, sparkContext=context)

    assert session.checkpoint_root(fake("s3://shared/ck/", "/other")) == "s3://shared/ck"
    assert session.checkpoint_root(fake(earlier="hdfs://shared/ck")) == "hdfs://shared/ck"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(fake())


def test_plans_prune_columns_and_partitions(spark):
    written = session.cut(
        spark.createDataFrame([("a", "X", 1), ("b", "Y", 2)], "subject_id string, predicate string, extra int"),
        "pruned", ("predicate",),
    )
    plan = written.where("predicate = 'X'").select("subject_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<subject_id:string>" in plan
    assert re.search(r"PartitionFilters: \[.*predicate.* = X", plan)


# The only places where rows reach the driver: one count row, and tables bounded by the model's levels.
# The similarity takes from an Arrow array inside a task.
ALLOWED = {("model.py", "collect"): 2, ("model.py", "first"): 1, ("similarity.py", "take"): 2}


def test_library_keeps_rows_on_the_executors():
    seen = {}
    for path in (ROOT / "kinweave").rglob("*.py"):
        if path.parent.name == "llm":  # has its own rules and tests
            continue
        source = path.read_text()
        assert "localCheckpoint" not in source and "crossJoin" not in source and ".rdd" not in source, path
        for node in ast.walk(ast.parse(source)):
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
                if node.func.attr in ("collect", "toPandas", "first", "take", "head", "toLocalIterator"):
                    seen[path.name, node.func.attr] = seen.get((path.name, node.func.attr), 0) + 1
    assert seen == ALLOWED


def test_published_run(spark, schema):
    with pytest.raises(ValueError):
        publish.publish_spine(spark)
    for name in publish.RAW_TABLES:
        catalog.save_table(guests.derive(spark, SF, name), name)
    with pytest.raises(ValueError, match="cohort_spend"):
        publish.publish_edge_table(spark)
    summary = dict(map(tuple, publish.publish_spine(spark, GIVEN_MODEL).collect()))
    raw_records = spark.table("guests_raw").count()
    assert summary["raw_source_records"] == raw_records and 150 <= summary["golden_guests"] <= raw_records
    assert summary["activity_cohorts"] == summary["cohort_spend_rows"]
    profile = dict(map(tuple, publish.publish_edge_table(spark).collect()))
    assert profile["RESOLVES_TO"] == raw_records and profile["VISITED_WITH"] % 2 == 0

    def rows(df):
        return sorted(map(tuple, df.collect()))

    table, spend = spark.table("gold_triplets"), spark.table("cohort_spend")
    names = relations.guest_names(spark.table("guests_resolved"), spark.table("guests_raw"))
    assert rows(spark.table("v_edges_labeled")) == rows(relations.labeled_edges(table, names))
    assert rows(spark.table("v_node_degree")) == rows(relations.companion_degree(table))
    assert rows(spark.table("mv_cohort_value")) == rows(metrics.cohort_value_metrics(spend).query())
    assert rows(spark.table("v_cohort_value").select("segment")) == rows(spend.select("segment"))
    assert spark.table("guest_influence").count() == summary["golden_guests"]
    assert spark.table("guest_2hop").where("hops = 1").count() == profile["VISITED_WITH"]
    assert spark.table("guest_communities").count() == spark.table("guest_centrality").count() == spark.table("guest_triangles").count()


def test_workers_import_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, with the package on its own path only, still runs the Python functions."""
    script = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "import __spark_entry__ as entry\n"
        "from kinweave.session import local_session\n"
        "spark = local_session(2, memory='2g')\n"
        f"print('rows', entry.queries()['er_gammas'](spark, {SF!r}).where('gamma_name > 2').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_components_leave_no_table_per_round(spark):
    from kinweave.operators.components import connected_components

    before = set(Path(session.checkpoint_root(spark).removeprefix("file:")).glob("*/*"))
    path = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(30)], "src string, dst string")
    found = connected_components(spark.createDataFrame([(f"n{i:02d}",) for i in range(31)], "id string"), path)
    assert found.select("component").distinct().count() == 1
    new = [d for d in Path(session.checkpoint_root(spark).removeprefix("file:")).glob("*/*") if d not in before]
    assert len(new) == 1 and len(list(new[0].iterdir())) <= 4


def test_stages_follow_their_input_files(spark, tmp_path):
    from kinweave.plans.stages import forget, stages

    for name in ("customer", "orders"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(20).write.parquet(f"{tmp_path}/{name}.parquet")
    first = stages(spark, str(tmp_path))
    assert stages(spark, f"{tmp_path}/") is first
    spark.read.parquet(f"{SF}/orders.parquet").limit(5).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    second = stages(spark, str(tmp_path))
    assert second is not first
    forget(spark, str(tmp_path))
    assert stages(spark, str(tmp_path)) is not second


def test_publishing_beside_the_files_of_another_application(spark):
    """An application's catalog may be gone while its folders are still in the shared warehouse."""
    from kinweave.plans.registry import registered

    spark.sql("CREATE SCHEMA IF NOT EXISTS kinweave_published")
    folder = Path(spark.catalog.getDatabase("kinweave_published").locationUri.removeprefix("file:"))
    for name in ("cohort_spend", "guest_cohorts"):
        spark.sql(f"DROP TABLE IF EXISTS kinweave_published.{name}")
        (folder / name).mkdir(parents=True, exist_ok=True)
        (folder / name / "part-of-another").write_text("")
    try:
        first = registered()["published_cohort_value"](spark, SF)
        second = registered()["published_cohort_value"](spark, SF)
        assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    finally:
        for name in ("cohort_spend", "guest_cohorts"):
            (folder / name / "part-of-another").unlink()
            (folder / name).rmdir()
