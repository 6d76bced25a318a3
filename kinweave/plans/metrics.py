"""Metric definitions: named dimensions and measures over one table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class MetricView:
    """``dimensions`` and ``measures`` map a public name to an expression over ``source``."""

    source: DataFrame
    dimensions: dict[str, Column]
    measures: dict[str, Column]

    def query(self, dimensions: list[str] | None = None, measures: list[str] | None = None) -> DataFrame:
        """The chosen measures grouped by the chosen dimensions; all of them by default."""
        by = list(self.dimensions) if dimensions is None else dimensions
        what = list(self.measures) if measures is None else measures
        unknown = (set(by) - set(self.dimensions)) | (set(what) - set(self.measures))
        if unknown or not what:
            raise ValueError(f"unknown or missing metric names: {sorted(unknown)}")
        aggregates = [self.measures[m].alias(m) for m in what]
        return self.source.groupBy(*[self.dimensions[d].alias(d) for d in by]).agg(*aggregates)


@dataclass(frozen=True)
class SketchedCube:
    """Sums and distinct counts at any grain from one stored table.

    The table has a row per combination of all ``dimensions`` with the ``sums`` and, for each of ``distinct``, a mergeable
    sketch of its values. Coarser grains and further batches are merged from such rows; the source is not read again.
    """

    dimensions: dict[str, Column]
    sums: dict[str, Column]
    distinct: dict[str, Column]
    lg_k: int = 12

    @property
    def error(self) -> float:
        """The relative standard error of a distinct count."""
        return 1.04 / 2 ** (self.lg_k / 2)

    def stored(self, source: DataFrame) -> DataFrame:
        """The cube's rows of a source or of one batch of it."""
        return source.groupBy(*[c.alias(d) for d, c in self.dimensions.items()]).agg(
            *[F.sum(c).alias(m) for m, c in self.sums.items()],
            *[F.hll_sketch_agg(c, F.lit(self.lg_k)).alias(m) for m, c in self.distinct.items()],
        )

    def merged(self, *cubes: DataFrame) -> DataFrame:
        """One cube of several batches' cubes. A value that several of them hold counts once."""
        return reduce(DataFrame.unionByName, cubes).groupBy(*self.dimensions).agg(
            *[F.sum(m).alias(m) for m in self.sums], *[F.hll_union_agg(m).alias(m) for m in self.distinct],
        )

    def rolled_up(self, cube: DataFrame, grains: list[list[str]]) -> DataFrame:
        """``grain``, the dimensions (null where the grain leaves them out), the sums and the estimated distinct counts."""
        return self._by_grain(cube, grains, [
            *[F.sum(m).alias(m) for m in self.sums],
            *[F.hll_sketch_estimate(F.hll_union_agg(m)).alias(m) for m in self.distinct],
        ])

    def exact(self, source: DataFrame, grains: list[list[str]]) -> DataFrame:
        """The same from the source, with exact distinct counts."""
        named = source.select(*[c.alias(n) for n, c in (self.dimensions | self.sums | self.distinct).items()])
        return self._by_grain(named, grains, [
            *[F.sum(m).alias(m) for m in self.sums], *[F.countDistinct(m).alias(m) for m in self.distinct],
        ])

    def _by_grain(self, rows: DataFrame, grains: list[list[str]], measures: list[Column]) -> DataFrame:
        unknown = {d for grain in grains for d in grain} - set(self.dimensions)
        if unknown or not grains:
            raise ValueError(f"unknown or missing dimensions: {sorted(unknown)}")
        names = list(self.dimensions)
        label = F.lit("all")
        for grain in grains:
            # Bit i (from the left) of grouping_id is set where dimension i is not part of the grain.
            left_out = int("".join("0" if d in grain else "1" for d in names), 2)
            label = F.when(F.col("_left_out") == left_out, F.lit(",".join(d for d in names if d in grain) or "all")).otherwise(label)
        found = rows.groupingSets([[F.col(d) for d in grain] for grain in grains], *names).agg(
            F.grouping_id(*names).alias("_left_out"), *measures
        )
        return found.select(label.alias("grain"), *names, *self.sums, *self.distinct)


def spend_cube() -> SketchedCube:
    """Spend, transactions and distinct spending guests by park, year and month."""
    return SketchedCube(
        {"park": F.col("park"), "year": F.substring("txn_date", 1, 4), "month": F.substring("txn_date", 6, 2)},
        {"spend_gbp": F.col("amount_gbp"), "transactions": F.lit(1)},
        {"guests": F.col("golden_id"), "cohorts": F.col("cohort_id")},
    )


def cohort_value_metrics(cohort_spend: DataFrame) -> MetricView:
    return MetricView(
        cohort_spend,
        {"segment": F.col("segment")},
        {
            "total_spend_gbp": F.sum("total_spend_gbp"),
            "cohorts": F.countDistinct("cohort_id"),
            "members": F.sum("cohort_members"),
        },
    )
