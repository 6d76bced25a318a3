"""Equi-join that splits hot keys over many tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from kinweave.session import cut, exchanged, observed

# A task joins at most about this many rows per side for one key.
SLICE_ROWS = 5_000
# Hot-key tables up to this many rows are broadcast, larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def _slices(df: DataFrame, keys: list[str], slice_rows: int, name: str) -> DataFrame:
    counted = df.dropna(subset=keys).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ceil = F.ceil(F.col("_n") / slice_rows).cast("int")
    return counted.where(F.col("_n") > slice_rows).select(
        *[f"_k{i}" for i in range(len(keys))],
        (ceil if name == "left" else F.lit(1)).alias("_ls"),
        (ceil if name == "right" else F.lit(1)).alias("_rs"),
        (ceil if name == "both" else F.lit(1)).alias("_bs"),
    )


def hot_keys(df: DataFrame, keys: list[str], slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, int]:
    """The key values with more than ``slice_rows`` rows, and their number."""
    seen = Observation()
    hot = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > slice_rows)
    hot = cut(hot.select(*keys).observe(seen, F.count(F.lit(1)).alias("n")), "hot-keys")
    return hot, observed(seen, hot, "n")[0]


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_keys: list[str],
    condition: Column | None = None,
    same_counts: bool = False,
    slice_rows: int | None = SLICE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Inner equi-join of two tables with disjoint column names, whole and balanced.

    Keys with more than ``slice_rows`` rows on a side are found by one pre-aggregated count. Such a
    key's rows are cut into slices and each left slice meets each right slice in a task of its own,
    so no task ever holds a whole hot key. Without hot keys this is a plain join.
    ``same_counts`` says that both sides hold the same rows per key, so one count is enough;
    ``slice_rows=None`` that the caller knows of no hot key. ``partitions`` is for joins that make far more rows than they
    read: the rows meet in just so many, while Spark coalesces partitions by what they read.
    """
    extra = [] if condition is None else [condition]
    out = [*left.columns, *right.columns]

    def met(a: DataFrame, b: DataFrame, a_keys: list[str], b_keys: list[str]) -> DataFrame:
        if partitions:
            a, b = a.repartition(partitions, *a_keys), b.repartition(partitions, *b_keys)
        on = [F.col(x) == F.col(y) for x, y in zip(a_keys, b_keys)]
        return a.join(exchanged(b), reduce(Column.__and__, on + extra)).select(*out)

    if slice_rows is None:
        return met(left, right, left_keys, right_keys)
    nk = len(left_keys)
    if same_counts:
        hot = _slices(left, left_keys, slice_rows, "both")
    else:
        hot = _slices(left, left_keys, slice_rows, "left").unionByName(
            _slices(right, right_keys, slice_rows, "right")
        )
    seen = Observation()
    hot = cut(
        hot.groupBy(*[f"_k{i}" for i in range(nk)]).agg(
            F.max(F.greatest("_ls", "_bs")).alias("_ls"), F.max(F.greatest("_rs", "_bs")).alias("_rs")
        ).observe(seen, F.count(F.lit(1)).alias("n")),
        "hot-keys",
    )
    n_hot = observed(seen, hot, "n")[0]
    if n_hot == 0:
        return met(left, right, left_keys, right_keys)

    hint = F.broadcast if n_hot <= BROADCAST_ROWS else (lambda df: df)

    def spread(df: DataFrame, keys: list[str], own: str, other: str, prefix: str) -> DataFrame:
        marks = reduce(Column.__and__, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
        mine = F.pmod(F.xxhash64(*df.columns), F.coalesce(F.col(own), F.lit(1))).cast("int")
        return df.join(hint(hot), marks, "left").select(
            *df.columns,
            mine.alias(f"{prefix}{own}"),
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)).alias(f"{prefix}{other}"),
        )

    a = spread(left, left_keys, "_ls", "_rs", "a")
    b = spread(right, right_keys, "_rs", "_ls", "b")
    return met(a, b, [*left_keys, "a_ls", "a_rs"], [*right_keys, "b_ls", "b_rs"])
