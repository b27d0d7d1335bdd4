"""Runs the shuffling operators on data where one key holds a third of all rows.

usage: python tools/skew_trial.py MILLION_ROWS SCRATCH_FOLDER

Prints, per operator, the wall time and the longest task beside the median task
of its slowest stage, read from Spark's event log. With nothing broadcast, a hot
key that met in one task would show as a longest task near the wall time.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from areafacts.operators import quality  # noqa: E402
from areafacts.operators.dedupe import one_per_key, top_per_group  # noqa: E402
from areafacts.operators.upsert import upsert  # noqa: E402
from areafacts.plans import feeds, marts  # noqa: E402
from areafacts.session import local_session  # noqa: E402


def make_places(spark, n: int):
    """A third copies of one place, a third places of one zip, a third spread."""
    kind = F.col("id") % 3
    number = F.when(kind == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 32).select(
        F.concat(number.cast("string"), F.lit(" Main St")).alias("address"),
        F.when(number % 2 == 0, "Restaurants, Italian").otherwise("Shopping").alias("categories"),
        F.lit(" Big City ").alias("city"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        F.concat(F.lit("place "), number.cast("string")).alias("name"),
        F.when(kind < 2, "10001").otherwise(F.lpad((F.col("id") % 40000).cast("string"), 5, "0")).alias("postal_code"),
        (F.xxhash64(number) % 500 + 500).alias("review_count"),
        ((F.pmod(F.xxhash64(number, F.lit(1)), F.lit(9)) + 2) / 2).alias("stars"),
        F.when(kind < 2, " NY").otherwise(F.concat(F.lit("S"), F.col("id") % 40000 % 50)).alias("state"),
    )


def make_areas(spark, n: int):
    """A third of the areas lie in one county; counties number in the thousands."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 32).select(
        F.col("id").cast("int").alias("zip"),
        F.concat(F.lit("s"), F.col("id") % 50).alias("state_id"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 3000)).alias("county_name"),
        F.lit(1000).alias("population"),
    )


def make_market(spark, areas):
    weeks = F.expr("sequence(date'2023-01-01', date'2024-02-18', interval 1 week)")
    return (
        areas.select("county_name", "state_id")
        .distinct()
        .withColumn("period_begin", F.explode(weeks))
        .select(
            "*",
            F.date_add("period_begin", 6).alias("period_end"),
            F.rand(1).alias("median_sale_price"),
            F.rand(2).alias("median_days_on_market"),
            F.lit(1).alias("active_listings"),
        )
    )


def stage_tasks(folder: str) -> dict[str, dict[int, list[int]]]:
    """Task times in ms per job description and stage."""
    label, tasks = {}, defaultdict(lambda: defaultdict(list))
    for path in glob.glob(f"{folder}/*"):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = (event.get("Properties") or {}).get("spark.job.description", "")
                label.update({stage: name for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Info"):
                info = event["Task Info"]
                tasks[label.get(event["Stage ID"], "")][event["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    return tasks


def main() -> None:
    n, home = int(float(sys.argv[1]) * 1_000_000), sys.argv[2]
    log = f"{home}/events-{os.getpid()}"
    os.makedirs(log)
    spark = local_session(
        8,
        app="skew trial",
        memory="16g",
        settings={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log,
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            # sizes in proportion to the data, so that skew counts as skew
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8m",
        },
    )

    def stored(name, make):
        path = f"{home}/{name}-{n}"
        if not os.path.exists(f"{path}/_SUCCESS"):
            make().write.parquet(path)
        return spark.read.parquet(path)

    raw = stored("raw_places", lambda: make_places(spark, n))
    areas = stored("areas", lambda: make_areas(spark, n // 2))
    market = stored("market", lambda: make_market(spark, areas))
    places = stored("places", lambda: feeds.places(raw, "2024-02-01"))
    # a stored table in which a third of the rows have a null in the key
    table = stored(
        "table",
        lambda: places.withColumn("address", F.when(F.xxhash64("address") % 3 != 0, F.col("address"))),
    )
    correction = places.withColumn("stars", F.lit(1.0))
    best = [F.col("stars").desc(), F.col("review_count").desc(), "name"]

    jobs = {
        "feed places": lambda: feeds.places(raw, "2024-02-01"),
        "one per key, ordered": lambda: one_per_key(raw, ["postal_code"], best),
        "top 50 per zip": lambda: top_per_group(raw, ["postal_code"], best, 50),
        "top 2000 per zip, sliced": lambda: top_per_group(raw, ["postal_code"], best, 2000, slices=64),
        "place quality": lambda: marts.place_quality(places),
        "area places": lambda: marts.area_places(areas, places),
        "area market": lambda: marts.area_market(areas, market),
        "upsert": lambda: upsert(table, correction, ["address", "name", "postal_code"]),
        "upsert, evolving": lambda: upsert(
            table, correction.drop("city"), ["address", "name", "postal_code"], evolve=True
        ),
        "orphans": lambda: quality.orphans(
            raw.select("postal_code"), areas.select(F.col("zip").cast("string").alias("postal_code")), ["postal_code"]
        ),
        "quality report": lambda: quality.report(raw, ["postal_code"], feeds.place_rules()),
    }
    walls = {}
    for name, make in jobs.items():
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - start
    spark.stop()

    tasks = stage_tasks(log)
    print(f"{n} raw places, {n // 2} areas, event log {log}")
    print("| Operator | Wall s | Longest task s | Median task s of that stage | Tasks |")
    print("| --- | --- | --- | --- | --- |")
    for name, wall in walls.items():
        times = max(tasks[name].values(), key=max)
        print(f"| {name} | {wall:.1f} | {max(times) / 1000:.2f} | {statistics.median(times) / 1000:.2f} | {len(times)} |")


if __name__ == "__main__":
    main()
