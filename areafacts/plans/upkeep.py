"""Marts that follow the deliveries: a merge's changes move the groups they touch, and nothing is computed again.

A mart's state is a keyed table of sums and counts per group. A delivery is merged into the base table, which writes its
change set beside the state first; the change set is then added up per group and joined to the states it touches. Every
step can be done again: a change set that is there is used, a group knows the delivery it had last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.operators.changes import DELIVERY, ROWS, Sum, advanced, partials
from areafacts.plans import marts
from areafacts.sources.keyed import KeyedTable


@dataclass(frozen=True)
class Mart:
    """Groups of a base table's rows, what is summed for each, and the columns made of the sums."""

    by: dict[str, Column]
    sums: tuple[Sum, ...]
    shown: Callable[[], dict[str, Column]]

    def state(self, spark: SparkSession, root: str, partition_by: Column | None = None) -> KeyedTable:
        return KeyedTable(spark, root, list(self.by), partition_by)

    def read(self, state: KeyedTable) -> DataFrame:
        """The mart; a group that lost its last row is not in it."""
        return state.read().where(F.col(ROWS) > 0).select(*self.by, *[c.alias(name) for name, c in self.shown().items()])

    def follow(self, base: KeyedTable, state: KeyedTable, source: DataFrame, delivery: str) -> list[str]:
        """Merge a delivery into ``base`` and bring ``state`` up to it; returns the state's partitions that changed.

        ``delivery`` names it, also when it comes again after a failure; only the last one may come again.
        """
        log = f"{state.root}/changes/{delivery}"
        base.merge(source, batch=delivery, log=log)
        if not scratch.exists(base.spark, log):
            return []  # an empty delivery
        summed = partials(base.spark.read.parquet(log), self.by, self.sums)
        state.ensure(summed.withColumn(DELIVERY, F.lit(delivery)).schema)
        delta, stored = scratch.written(summed, "delta")  # both joins with it read the sums, not the change set
        try:
            return state.merge(advanced(state.read(), delta, list(self.by), delivery), null_safe=True)
        finally:
            scratch.remove(state.spark, stored)


def place_mart(category: str = marts.RESTAURANTS) -> Mart:
    """:func:`areafacts.plans.marts.place_summary`, kept up."""
    stars, reviews = F.col("stars"), F.col("review_count")
    hit = F.coalesce(marts.has_category(category), F.lit(False))
    rating, product = Sum("stars", stars), Sum("product", stars * reviews)
    weight = Sum("weight", F.when(stars.isNotNull(), reviews))
    inside, rated = Sum("hit", F.when(hit, 1)), Sum("category_stars", F.when(hit, stars))

    def shown() -> dict[str, Column]:
        return {
            "places": F.col(ROWS),
            "category_places": F.col(inside.columns[1]),
            "mean_stars": rating.mean,
            "weighted_stars": F.try_divide(F.col(product.columns[0]).cast("double"), F.col(weight.columns[0]).cast("double")),
            "category_stars": rated.mean,
        }

    return Mart({"zip": F.col("zip_int"), "state_id": F.col("state")}, (rating, product, weight, inside, rated), shown)
