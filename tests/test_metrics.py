"""The cube of sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from kinweave.plans.metrics import SketchedCube

GRAINS = [["park", "year"], ["park"], ["year"], []]


@pytest.fixture
def cube(spark):
    return SketchedCube(
        {"park": F.col("park"), "year": F.col("year")}, {"spend": F.col("amount"), "rows": F.lit(1)}, {"guests": F.col("guest")}
    )


def visits(spark, n):
    rows = spark.range(n)
    return rows.select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("p"), F.col("id") % 5)).alias("park"), (F.col("id") % 3 + 2020).alias("year"),
        (F.col("id") % 11).alias("amount"), F.when(F.col("id") % 13 > 0, F.col("id") % 8_191).cast("string").alias("guest"),
    )


def by_key(df):
    return {(r.grain, r.park, r.year): (r.spend, r.rows, r.guests) for r in df.collect()}


def test_grains_from_one_stored_table(spark, cube):
    """Three batches whose guests overlap, merged: sums exact, distinct counts within four standard errors."""
    source = visits(spark, 60_000)
    stored = cube.merged(*[cube.stored(source.where(F.pmod(F.hash("amount"), F.lit(3)) == b)) for b in range(3)])
    about, exact = by_key(cube.rolled_up(stored, GRAINS)), by_key(cube.exact(source, GRAINS))
    assert about.keys() == exact.keys() and len(exact) == 6 * 3 + 6 + 3 + 1
    for key, (spend, rows, guests) in exact.items():
        assert about[key][:2] == (spend, rows)
        assert abs(about[key][2] - guests) <= 4 * cube.error * guests
    # A missing park is a park of its own, not the total.
    assert exact["park", None, None][1] < exact["all", None, None][1] == 60_000


def test_small_counts_nulls_and_empty_tables(spark, cube):
    few = spark.createDataFrame([("a", 2020, 1, "x"), ("a", 2020, 2, "x"), ("b", 2021, None, None)], "park string, year int, amount int, guest string")
    found = by_key(cube.rolled_up(cube.stored(few), GRAINS))
    assert found == by_key(cube.exact(few, GRAINS))
    assert found["park", "b", None] == (None, 1, 0) and found["all", None, None] == (3, 3, 1)
    assert by_key(cube.rolled_up(cube.stored(few.limit(0)), [["park"]])) == {}


def test_unknown_grains_are_refused(spark, cube):
    with pytest.raises(ValueError):
        cube.exact(visits(spark, 5), [["city"]])
    with pytest.raises(ValueError):
        cube.exact(visits(spark, 5), [])
