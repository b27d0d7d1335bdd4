"""Distinct counts and quantiles that are kept per delivery and united, instead of counted anew over all of them.

A sketch has a few kilobytes whatever it has seen. Tasks make sketches of their rows, Spark unites them; those of a
delivery are stored, and a report over any deliveries unites the stored ones without a look at their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areafacts.operators.reshape import quoted

# HyperLogLog with 2^14 registers: a standard error of 0.8%. KLL with k = 400: ranks to 0.7% with 99% confidence.
REGISTERS, RANKS = 14, 400
DELIVERY = "delivery"


def sketch(df: DataFrame, distinct: Sequence[str] = (), quantiles: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``n_rows``, and for each column its known values and its sketches.

    Nulls are counted out. A column is counted by its text; quantiles take numbers.
    """
    parts: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for c in dict.fromkeys([*distinct, *quantiles]):
        parts.append(F.count(F.col(quoted(c))).alias(f"known:{c}"))
    parts += [F.hll_sketch_agg(F.col(quoted(c)).cast("string"), REGISTERS).alias(f"distinct:{c}") for c in distinct]
    parts += [F.kll_sketch_agg_double(F.col(quoted(c)).cast("double"), F.lit(RANKS)).alias(f"quantiles:{c}") for c in quantiles]
    return df.groupBy(*by).agg(*parts)


def keep(sketches: DataFrame, path: str, delivery: str) -> None:
    """Store a delivery's sketches; a delivery that comes again replaces its own."""
    named = sketches.withColumn(DELIVERY, F.lit(delivery))
    named.write.mode("overwrite").partitionBy(DELIVERY).option("partitionOverwriteMode", "dynamic").parquet(path)


def kept(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several deliveries (or groups) as one row per ``by``; what is united may be united again."""
    parts: list[Column] = []
    for c in sketches.columns:
        column, (kind, _, _) = F.col(quoted(c)), c.partition(":")
        if kind in ("n_rows", "known"):
            parts.append(F.sum(column).alias(c))
        elif kind == "distinct":
            parts.append(F.hll_union_agg(column).alias(c))
        elif kind == "quantiles":
            parts.append(F.kll_merge_agg_double(column, F.lit(RANKS)).alias(c))
    return sketches.groupBy(*by).agg(*parts)


def estimates(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """``by, column, n_rows, missing, distinct, quantiles``: one row per group and sketched column.

    What was not sketched, or of which nothing is known, is null (no distinct value: 0).
    """
    columns = [c.removeprefix("known:") for c in sketches.columns if c.startswith("known:")]
    rows = []
    for c in columns:
        known = F.col(quoted(f"known:{c}"))
        values, distinct = F.lit(None).cast("array<double>"), F.lit(None).cast("long")
        if f"quantiles:{c}" in sketches.columns:
            at = [F.kll_sketch_get_quantile_double(F.col(quoted(f"quantiles:{c}")), F.lit(p)) for p in probabilities]
            values = F.when(known > 0, F.array(*at))
        if f"distinct:{c}" in sketches.columns:
            distinct = F.when(known > 0, F.hll_sketch_estimate(F.col(quoted(f"distinct:{c}")))).otherwise(0)
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col("n_rows"),
                (F.col("n_rows") - known).alias("missing"),
                distinct.alias("distinct"),
                values.alias("quantiles"),
            )
        )
    return sketches.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")
