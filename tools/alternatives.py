"""Times each chosen plan against the plain way to write the same result.

usage: python tools/alternatives.py SCRATCH_FOLDER

The plain forms are what a straightforward job would run: inferred schemas,
Spark's unpivot whatever the width, de-duplication of the long rows,
``dropDuplicates`` on rows with text, a full outer join for every upsert.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from areafacts.functions import normalize as N  # noqa: E402
from areafacts.operators.dedupe import one_per_key  # noqa: E402
from areafacts.operators.reshape import quoted, split_columns, wide_to_long  # noqa: E402
from areafacts.operators.upsert import upsert  # noqa: E402
from areafacts.plans import feeds  # noqa: E402
from areafacts.session import local_session  # noqa: E402
from areafacts.sources import readers  # noqa: E402

MONTHS = [f"20{y:02d}-{m:02d}-28" for y in range(25) for m in range(1, 13)]


def make_wide(spark, n: int):
    return spark.range(0, n, 1, 16).select(
        (F.col("id") % (n * 3 // 4)).cast("int").alias("RegionID"),
        F.lit(1).alias("SizeRank"),
        F.col("id").cast("int").alias("RegionName"),
        F.concat(F.lit(" S"), F.col("id") % 50).alias("State"),
        F.concat(F.lit("City "), F.col("id")).alias("City"),
        F.concat(F.lit("C"), F.col("id") % 3000, F.lit(" County")).alias("CountyName"),
        *[F.round(F.rand(i) * 900000, 2).alias(m) for i, m in enumerate(MONTHS)],
    )


def make_market(spark, n: int):
    return spark.range(0, n, 1, 16).select(
        F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 400 * 7).cast("int")).alias("period_begin"),
        F.date_add(F.lit("2017-01-07").cast("date"), (F.col("id") % 400 * 7).cast("int")).alias("period_end"),
        F.lit(5).alias("region_type_id"),
        F.concat(F.lit("C"), F.col("id") % 3000, F.lit(" County, S"), F.col("id") % 50).alias("region_name"),
        *[F.round(F.rand(i) * 1000, 2).alias(f"metric_{i}") for i in range(32)],
    )


def plain_long(wide):
    ids, values = split_columns(wide.columns)
    return wide.unpivot(ids, [quoted(c) for c in values], "Date", "Value")


def plain_upsert(target, source, key):
    t, s = target.alias("t"), source.withColumn("__new", F.lit(True)).alias("s")
    pick = [F.when(F.col("s.__new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*pick)


def main() -> None:
    home = sys.argv[1]
    spark = local_session(8, app="alternatives", memory="16g", settings={"spark.sql.shuffle.partitions": "16"})

    def stored(name, write):
        path = f"{home}/{name}"
        if not os.path.exists(f"{path}/_SUCCESS"):
            write(path)
        return path

    wide_rows, market_rows, stored_rows = 100_000, 1_000_000, 20_000_000
    wide = spark.read.parquet(stored("wide", lambda p: make_wide(spark, wide_rows).write.parquet(p)))
    tsv = stored(
        "market", lambda p: make_market(spark, market_rows).write.option("header", True).option("sep", "\t").csv(p)
    )
    market_schema = T.StructType(
        [
            T.StructField("period_begin", T.DateType()),
            T.StructField("period_end", T.DateType()),
            T.StructField("region_type_id", T.IntegerType()),
            T.StructField("region_name", T.StringType()),
            *[T.StructField(f"metric_{i}", T.DoubleType()) for i in range(32)],
        ]
    )
    table = spark.read.parquet(
        stored("table", lambda p: spark.range(0, stored_rows, 1, 16).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.col("id").cast("string").alias("text")).write.parquet(p))
    )
    batch = spark.read.parquet(
        stored("batch", lambda p: spark.range(stored_rows - 50_000, stored_rows + 50_000, 1, 16).select("id", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit("new").alias("text")).write.parquet(p))
    )
    cleaned = wide.withColumns({"state_id": N.label("State"), "county_name": N.county("CountyName")})

    def read_explicit():
        return readers.read_delimited(spark, tsv, market_schema, sep="\t")

    def read_inferred():
        return readers.read_delimited(spark, tsv, None, sep="\t")

    pairs = {
        f"unpivot {wide_rows:,} x {len(MONTHS)} months": (
            lambda: plain_long(wide),
            lambda: wide_to_long(wide),
        ),
        "value index, one row per region and month": (
            lambda: plain_long(cleaned).dropDuplicates(["RegionID", "state_id", "Date"]),
            lambda: feeds.value_index(wide),
        ),
        f"one of {wide_rows:,} rows of {len(MONTHS) + 8} columns per key": (
            lambda: cleaned.dropDuplicates(["RegionID", "state_id"]),
            lambda: one_per_key(cleaned, ["RegionID", "state_id"]),
        ),
        f"market feed from TSV, {market_rows:,} rows": (
            lambda: feeds.market_weekly(read_inferred()),
            lambda: feeds.market_weekly(read_explicit()),
        ),
        f"upsert of 100,000 rows into {stored_rows:,}": (
            lambda: plain_upsert(table, batch, "id"),
            lambda: upsert(table, batch, ["id"]),
        ),
    }
    print("| Job | Plain s | Chosen s | Ratio |")
    print("| --- | --- | --- | --- |")
    for name, jobs in pairs.items():
        medians = []
        for make in jobs:
            times = []
            for _ in range(4):
                start = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            medians.append(statistics.median(times[1:]))
        print(f"| {name} | {medians[0]:.2f} | {medians[1]:.2f} | {medians[0] / medians[1]:.1f}x |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
