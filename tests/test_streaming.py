import os
import time

import pytest
from pyspark.sql import functions as F

from areafacts.operators.dedupe import one_per_key
from areafacts.plans import feeds
from areafacts.sources.keyed import KeyedTable
from areafacts.streaming import ingest as streams

HEADER = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,2023-01-31,2023-02-28\n"


def deliver(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write(HEADER + "".join(line + "\n" for line in lines))
    stamp = time.time() - 1000 + len(os.listdir(folder))
    os.utime(path, (stamp, stamp))  # files are taken in modification-time order
    return path


def region(i, *values):
    return f"{i},1,{10000 + i},zip,NY,NY,City,Metro,Kings County,{','.join(map(str, values))}"


def test_streamed_files_equal_batch_merges(spark, tmp_path, rows):
    drop = str(tmp_path / "drop")
    paths = [
        deliver(drop, "a.csv", region(1, 100, 110), region(2, 200, 210)),
        deliver(drop, "b.csv", region(2, 201, 211), region(3, 300, "")),
        deliver(drop, "c.csv", region(1, 101, 111)),
    ]
    spec = feeds.FEEDS["value_index"]
    batch = spec.store(spark, str(tmp_path / "batch"))
    for path in paths:
        feeds.run(spark, spec, path, batch)

    streamed = spec.store(spark, str(tmp_path / "streamed"))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        streams.ingest_feed(spark, spec, drop, paths[0], streamed, checkpoint, max_files=1).awaitTermination()

    def batches():
        return len([n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()])

    run()
    assert rows(streamed.read()) == rows(batch.read())
    assert batches() == 3

    # all files in one micro-batch: the last one written still wins
    at_once = spec.store(spark, str(tmp_path / "at_once"))
    streams.ingest_feed(spark, "value_index", drop, paths[0], at_once, str(tmp_path / "other")).awaitTermination()
    assert rows(at_once.read()) == rows(batch.read())

    # nothing new: a second run takes no batch
    run()
    assert batches() == 3

    # a later delivery is picked up by the next run
    deliver(drop, "d.csv", region(9, 1, 2))
    run()
    assert streamed.read().where("RegionID = 9").count() == 2


def test_replay_of_a_batch_changes_nothing(spark, tmp_path, rows):
    """After a failure a micro-batch is delivered again; a fresh checkpoint replays all."""
    drop = str(tmp_path / "drop")
    path = deliver(drop, "a.csv", region(1, 100, 110))
    spec = feeds.FEEDS["value_index"]
    store = spec.store(spark, str(tmp_path / "table"))
    for run in range(2):
        streams.ingest_feed(spark, spec, drop, path, store, str(tmp_path / f"checkpoint{run}")).awaitTermination()
    assert store.read().count() == 2


def test_replayed_rows_with_null_keys_are_not_added_again(spark, tmp_path):
    """The checkpoint's last commit is lost: the same micro-batch comes once more."""
    drop, checkpoint = tmp_path / "drop", str(tmp_path / "checkpoint")
    drop.mkdir()
    (drop / "a.json").write_text(
        '{"name": "a", "city": "c", "state": "NY", "stars": 4, "postal_code": "00501"}\n{bad\n'
    )
    store = feeds.FEEDS["places"].store(spark, str(tmp_path / "table"))

    def run():
        streams.ingest_feed(spark, "places", str(drop), str(drop), store, checkpoint, as_of="2024-02-01").awaitTermination()

    run()
    assert store.read().where("address IS NULL").count() == 1
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert store.read().count() == 1
    kept = spark.read.parquet(f"{store.root}/rejects/*")
    assert [(r["reasons"], r["row"]) for r in kept.collect()] == [(["corrupt"], "{bad")]


def test_monthly_deliveries_of_a_growing_table(spark, tmp_path, rows):
    """Each month's file has a column more; all in one run, and one by one."""
    drop = tmp_path / "drop"
    drop.mkdir()
    months = ["2023-01-31", "2023-02-28", "2023-03-31"]
    for n in range(1, 4):
        path = drop / f"{n}.csv"
        path.write_text(HEADER.split(",2023")[0] + "," + ",".join(months[:n]) + "\n" + region(1, *[100 * n + i for i in range(n)]) + "\n" + region(n, *range(n)) + "\n" * (n > 1))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    found = []
    for run, most in enumerate((None, 1)):
        store = feeds.FEEDS["value_index"].store(spark, str(tmp_path / f"t{run}"))
        streams.ingest_feed(
            spark, "value_index", str(drop), "", store, str(tmp_path / f"c{run}"), max_files=most, as_of="2024-02-01"
        ).awaitTermination()
        found.append(rows(store.read(), "RegionID", "Date", "Value"))
    assert found[0] == found[1]
    assert {(d, v) for i, d, v in found[0] if i == 1} == {("2023-01-31", 300.0), ("2023-02-28", 301.0), ("2023-03-31", 302.0)}


def test_failing_batch_keeps_the_table(spark, tmp_path, rows):
    drop = str(tmp_path / "drop")
    spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double").write.parquet(drop)
    store = KeyedTable(spark, str(tmp_path / "table"), ["k"])
    stream = spark.readStream.schema("k int, v double").parquet(drop)
    with pytest.raises(Exception, match="duplicate key"):
        streams.ingest(stream, lambda b: b, store, str(tmp_path / "c")).awaitTermination()
    assert store.read().count() == 0
    fixed = streams.ingest(
        stream, lambda b: one_per_key(b, ["k"], [F.col("v").desc()]), store, str(tmp_path / "c")
    )
    fixed.awaitTermination()
    assert rows(store.read()) == [(1, 2.0)]


def test_stream_dedupe(spark, tmp_path, rows):
    drop, out = str(tmp_path / "drop"), str(tmp_path / "out")
    data = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (2, "2024-01-01 00:00:00")]
    schema = "k int, ts timestamp_ntz"

    def write(items):
        spark.createDataFrame(items, "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts")).write.mode(
            "append"
        ).parquet(drop)

    def run():
        stream = spark.readStream.schema(schema).parquet(drop)
        query = streams.dedupe(stream, ["k"], "ts", "1 hour")
        query.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
            out, format="parquet", outputMode="append"
        ).awaitTermination()

    write(data)
    run()
    write([(1, "2024-01-01 00:30:00"), (3, "2024-01-01 00:30:00")])
    run()
    assert rows(spark.read.parquet(out), "k") == [(1,), (2,), (3,)]


def test_every_feed_streams(spark, tmp_path):
    """TSV, CSV and JSON deliveries through their feeds."""
    drops = {name: tmp_path / name for name in ("market_weekly", "area_reference", "places")}
    for folder in drops.values():
        folder.mkdir()
    (drops["market_weekly"] / "a.tsv").write_text(
        "period_begin\tperiod_end\tregion_type_id\tregion_name\tmedian_sale_price\n"
        "2023-01-01\t2023-01-07\t5\tKing County, WA\t5.5\n2023-01-01\t2023-01-07\t6\tSeattle, WA\t1\n"
    )
    (drops["area_reference"] / "a.csv").write_text("zip,city,state_id,county_name,zcta\n501,H,NY,Suffolk County,x\n")
    (drops["places"] / "a.json").write_text(
        '{"address": "1", "name": "a", "city": "c", "state": "NY", "stars": 4, "postal_code": "00501"}\nbad\n'
    )
    for name, folder in drops.items():
        like = str(next(folder.iterdir()))
        store = feeds.FEEDS[name].store(spark, str(tmp_path / f"{name}-table"))
        streams.ingest_feed(
            spark, name, str(folder), like, store, str(tmp_path / f"{name}-check"), as_of="2024-02-01"
        ).awaitTermination()
        assert store.read().count() == 1, name
        assert "_arrived" not in store.read().columns
