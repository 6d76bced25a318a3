"""Tables, views and comments in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

GUESTS_RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("record_id", "source_system", "first_name", "last_name")]
    + [T.StructField(c, T.StringType(), True) for c in ("email", "phone", "postcode", "dob")]
    + [T.StructField("home_park", T.StringType(), False), T.StructField("true_id", T.LongType(), False)]
)
BOOKINGS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("booking_id", "party_id", "payer_record_id", "park", "booking_date")]
)
PARTY_MEMBERS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("party_id", "record_id", "booking_id")]
)
TRANSACTIONS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("txn_id", "record_id", "park")]
    + [T.StructField("amount_gbp", T.DoubleType(), False), T.StructField("txn_date", T.StringType(), False)]
)
# Everything the relationship and value steps read.
REQUIRED_TABLES = ("guests_raw", "guests_resolved", "party_members", "bookings", "transactions")


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def use_schema(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Create the schema if needed and make it current."""
    if not schema.strip():
        raise ValueError("a target schema is needed")
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")
    spark.catalog.setCurrentDatabase(schema)


def table_from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small hand-made tables with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def save_table(
    df: DataFrame, name: str, comment: str | None = None, column_comments: dict[str, str] | None = None,
    fmt: str = "parquet", partition_by: tuple[str, ...] = (), path: str | None = None,
) -> DataFrame:
    """Create or replace a table from a query, schema included, and return its scan.

    The files lie in the schema's folder, or in ``path``, a new folder of the caller's; then those of a replaced table stay.
    """
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS {_text(comment)}")
    for column, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {_quoted(name)} ALTER COLUMN {_quoted(column)} COMMENT {_text(text)}")
    return spark.table(name)


def create_view(
    spark: SparkSession, name: str, query: str, comment: str | None = None,
    column_comments: dict[str, str] | None = None,
) -> DataFrame:
    """Create or replace a view over tables; ``column_comments`` then name all its columns in order."""
    columns = ""
    if column_comments:
        columns = " (" + ", ".join(f"{_quoted(c)} COMMENT {_text(t)}" for c, t in column_comments.items()) + ")"
    said = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)}{columns}{said} AS {query}")
    return spark.table(name)


def comments(spark: SparkSession, name: str) -> tuple[str | None, dict[str, str]]:
    """The comment of a table or view, and those of its columns, as the catalog has them."""
    of_columns = {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}
    return spark.catalog.getTable(name).description, of_columns


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")


def require_tables(spark: SparkSession, names: Iterable[str] = REQUIRED_TABLES) -> None:
    missing = sorted(n for n in names if not spark.catalog.tableExists(n))
    if missing:
        raise ValueError(f"missing prerequisite tables: {', '.join(missing)}")
