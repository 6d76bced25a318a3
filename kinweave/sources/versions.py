"""Tables that are replaced without a reader ever seeing half of one.

Every version is a table of its own. The name that readers use is a view, which moves to a new version in one step of the
catalog once that is whole. ``catalog.save_table`` overwrites in place, which is simpler where nobody reads meanwhile.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from kinweave.sources import catalog

_VERSION = "{name}__v{number:06d}_{tag}"


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    schema, _, short = name.rpartition(".")
    return schema or spark.catalog.currentDatabase(), short


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables that hold versions of ``name``, oldest first."""
    schema, short = _split(spark, name)
    pattern = re.compile(re.escape(short.lower()) + r"__v(\d{6,})_[0-9a-f]{8}")
    found = [(int(m[1]), t.name) for t in spark.catalog.listTables(schema) if (m := pattern.fullmatch(t.name.lower()))]
    return [f"{schema}.{table}" for _, table in sorted(found)]


def replace_table(
    df: DataFrame, name: str, comment: str | None = None, column_comments: dict[str, str] | None = None,
    fmt: str = "parquet", partition_by: tuple[str, ...] = (), keep: int = 1,
) -> DataFrame:
    """Write ``df`` as the next version of ``name``, move the view ``name`` to it and return its scan.

    A query that names the view before the move reads the old version to its end, as the last ``keep`` versions stay; one that
    names it after reads the new. If the write fails nothing is seen of it, and what it wrote is deleted. ``df`` may read
    ``name`` itself. A table called ``name`` that is no view is refused.
    """
    spark = df.sparkSession
    schema, short = _split(spark, name)
    view = f"{schema}.{short}"
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        raise ValueError(f"{view} is a table; drop or rename it, so that a view over versions can have its name")
    before = versions(spark, view)
    number = 1 + max((int(t.rpartition("__v")[2].partition("_")[0]) for t in before), default=0)
    table = f"{schema}.{_VERSION.format(name=short, number=number, tag=uuid.uuid4().hex[:8])}"
    try:
        saved = catalog.save_table(df, table, comment, column_comments, fmt, partition_by)
        columns = {c: (column_comments or {}).get(c, "") for c in saved.columns} if column_comments else None
        catalog.create_view(spark, view, f"SELECT * FROM {catalog._quoted(table)}", comment, columns)
    except Exception:
        _drop(spark, table)
        raise
    for old in before[: max(0, len(before) - keep)]:
        _drop(spark, old)
    return spark.table(view)


def _drop(spark: SparkSession, table: str) -> None:
    """Drop a version, its files too where a failed write left some without an entry in the catalog."""
    spark.sql(f"DROP TABLE IF EXISTS {catalog._quoted(table)}")
    schema, _, short = table.rpartition(".")
    folder = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(schema).locationUri, short.lower())
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_versions(spark: SparkSession, name: str) -> None:
    """Drop the view and all its versions."""
    catalog.drop_view(spark, name)
    for table in versions(spark, name):
        _drop(spark, table)
