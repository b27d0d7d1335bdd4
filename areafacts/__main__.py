"""Jobs for a scheduler: ``spark-submit ... -m areafacts`` or ``python -m areafacts``.

    run FEED PATH TABLE [--as-of DATE]           merge one delivered file or folder
    ingest FEED FOLDER LIKE TABLE CHECKPOINT     merge what has arrived since the last run

Shuffles are sized by the files under PATH or FOLDER and the table's; ``--input-gb N`` says otherwise, ``--cores N``
is the least number of tasks by half. ``--from`` and ``--to`` bound the months of a value_index.

FEED is one of market_weekly, area_reference, places, value_index.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from areafacts.plans import feeds
from areafacts.session import SETTINGS, sized_settings, stored_bytes
from areafacts.streaming.ingest import ingest_feed


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="areafacts", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("feed", choices=sorted(feeds.FEEDS))
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    for sub in (job("run", "path", "table"), job("ingest", "folder", "like", "table", "checkpoint")):
        sub.add_argument("--as-of", default=None, help="ingest date instead of today's")
        sub.add_argument("--input-gb", type=int, default=None, help="size of the batch and the touched partitions")
        sub.add_argument("--from", dest="dates_from", default=None, help="first month of a value_index")
        sub.add_argument("--to", dest="dates_to", default=None, help="last month of a value_index")
        sub.add_argument("--cores", type=int, default=8, help="cores of the cluster")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    builder = SparkSession.builder.appName(f"areafacts {args.job} {args.feed}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    options = {}
    delivered = args.path if args.job == "run" else args.folder
    size = args.input_gb * 1024**3 if args.input_gb else stored_bytes(spark, delivered) + stored_bytes(spark, args.table)
    for key, value in sized_settings(size, args.cores).items():
        spark.conf.set(key, value)
    if args.feed == "value_index":
        options = {"dates_from": args.dates_from, "dates_to": args.dates_to}
    store = feeds.FEEDS[args.feed].store(spark, args.table)
    if args.job == "run":
        done = feeds.run(spark, args.feed, args.path, store, as_of=args.as_of, **options)
        print(", ".join(f"{n:,} {what}" for what, n in done.counts.items()) or "no rows")
    else:
        ingest_feed(
            spark, args.feed, args.folder, args.like, store, args.checkpoint, as_of=args.as_of, **options
        ).awaitTermination()
    print(f"{len(store.partitions()) if store.schema() else 0} partitions")


if __name__ == "__main__":
    main(sys.argv[1:])
