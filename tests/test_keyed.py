import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.plans import feeds
from areafacts.sources.keyed import KeyedTable

SCHEMA = "day string, k int, v double"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), ["day", "k"], F.substring("day", 1, 4))


def files(store):
    """Names of the files of each partition."""
    data = os.path.join(store.root, "data")
    return {p: {f for f in os.listdir(os.path.join(data, p)) if f.endswith(".parquet")} for p in os.listdir(data) if p.startswith("bucket=")}


def test_merge(store, spark, rows):
    assert store.schema() is None
    with pytest.raises(FileNotFoundError):
        store.read()
    first = store.merge(batch(spark, ("2020-01-01", 1, 1.0), ("2021-01-01", 1, 2.0)))
    second = store.merge(batch(spark, ("2021-01-01", 1, 9.0), ("2022-01-01", 2, 3.0)))
    assert (first, second) == (["2020", "2021"], ["2021", "2022"])
    assert store.partitions() == ["2020", "2021", "2022"]
    assert rows(store.read()) == [("2020-01-01", 1, 1.0), ("2021-01-01", 1, 9.0), ("2022-01-01", 2, 3.0)]


def test_untouched_partitions_are_not_rewritten(store, spark):
    store.merge(batch(spark, ("2020-01-01", 1, 1.0), ("2021-01-01", 1, 2.0)))
    before = files(store)
    store.merge(batch(spark, ("2021-05-05", 1, 1.0)))
    after = files(store)
    assert after["bucket=2020"] == before["bucket=2020"]
    assert not after["bucket=2021"] & before["bucket=2021"]


def test_an_empty_table_and_an_empty_batch(store, spark, rows):
    schema = batch(spark, ("2020-01-01", 1, 1.0)).schema
    assert store.ensure(schema) and not store.ensure(schema)
    assert rows(store.read()) == [] and store.partitions() == []
    assert store.merge(spark.createDataFrame([], SCHEMA)) == []
    assert store.read().schema == schema


def test_a_merge_reads_and_writes_its_partitions_only(store, spark):
    """The filter on the partitions reaches the listing, and nothing is written but the result."""
    from tests.conftest import plan_of

    store.merge(batch(spark, ("2020-01-01", 1, 1.0), ("2021-01-01", 1, 2.0)))
    seen = []
    write = store._write
    store._write = lambda result: (seen.append(plan_of(result)), write(result))
    store.merge(batch(spark, ("2021-01-01", 1, 3.0)))
    assert "PartitionFilters: [isnotnull(bucket" in seen[0] and "(bucket" in seen[0] and "= 2021)" in seen[0]


@pytest.mark.parametrize("feed", ["places", "area_reference"])
def test_feeds_without_a_date_are_partitioned_by_their_key(spark, tmp_path, feed):
    from areafacts import schemas as S

    spec = feeds.FEEDS[feed]
    store = spec.store(spark, str(tmp_path / "t"))
    name, kind, schema = ("postal_code", str, S.PLACE) if feed == "places" else ("zip", int, S.AREA)

    def delivery(*codes):
        given = spark.createDataFrame([(kind(c), c) for c in codes], f"{name} {'string' if kind is str else 'int'}, city string")
        extra = [F.lit("a" if f.name in ("address", "name") else None).cast(f.dataType).alias(f.name) for f in schema if f.name not in (name, "city")]
        return given.select("*", *extra).select(*schema.names)

    store.merge(delivery("10001", "20002"))
    before = files(store)
    assert len(store.merge(delivery("10002"))) == 1
    after = files(store)
    assert len(after) == 2 and sum(after[k] == before[k] for k in before) == 1


def test_a_batch_that_comes_again_adds_nothing(store, spark, rows):
    rows_in = batch(spark, (None, 1, 1.0), ("2020-01-01", 1, 1.0))
    store.merge(rows_in, batch="q-0")
    store.merge(rows_in, batch="q-0")
    assert store.read().count() == 2
    store.merge(rows_in, batch="q-1")
    store.merge(rows_in, batch="other-0")
    store.merge(rows_in)
    store.merge(rows_in)
    assert store.read().where("day IS NULL").count() == 5
    store.merge(batch(spark, (None, 1, 7.0)), batch="q-1")  # the same batch, read anew
    assert rows(store.read().where("day IS NULL"), "v") == [(1.0,)] * 4 + [(7.0,)]


def test_more_partitions_than_anyone_lists(spark, tmp_path):
    store = KeyedTable(spark, str(tmp_path / "many"), ["k"], F.col("k"))
    store.merge(spark.range(300).select(F.col("id").cast("int").alias("k"), F.lit(1.0).alias("v")))
    assert store.read().count() == 300 and len(store.partitions()) == 300


def test_rerun_changes_nothing(store, spark, rows):
    rows_in = batch(spark, ("2020-01-01", 1, 1.0), ("2021-01-01", 1, 2.0))
    store.merge(rows_in)
    store.merge(rows_in)
    assert rows(store.read()) == rows(rows_in)


def test_null_partition_and_key(store, spark, rows):
    null_row = batch(spark, (None, 1, 1.0))
    store.merge(null_row)
    store.merge(null_row)
    assert store.read().count() == 2
    assert store.partitions() == ["none"]


def test_failed_merge_leaves_the_table_as_it_was(store, spark, rows):
    store.merge(batch(spark, ("2020-01-01", 1, 1.0)))
    with pytest.raises(Exception, match="duplicate key"):
        store.merge(batch(spark, ("2020-01-01", 2, 1.0), ("2020-01-01", 2, 2.0)))
    assert rows(store.read()) == [("2020-01-01", 1, 1.0)]


def test_staged_batches_are_removed(store, spark):
    home = os.path.dirname(scratch.folder(spark, "x"))
    count = lambda: len([n for n in os.listdir(home) if n.startswith("batch-")]) if os.path.exists(home) else 0
    before = count()
    store.merge(batch(spark, ("2020-01-01", 1, 1.0)))
    assert count() == before


def test_evolution_reads_old_files_with_nulls(store, spark, rows):
    store.merge(batch(spark, ("2020-01-01", 1, 1.0), ("2021-01-01", 1, 2.0)))
    store.merge(batch(spark, ("2021-01-01", 1, 5.0)).withColumn("note", F.lit("n")), evolve=True)
    assert rows(store.read()) == [("2020-01-01", 1, 1.0, None), ("2021-01-01", 1, 5.0, "n")]
    store.merge(batch(spark, ("2020-01-01", 1, 7.0)).drop("v"), evolve=True)
    assert rows(store.read(), "k", "v") == [(1, 1.0), (1, 5.0)]


def test_unpartitioned(spark, tmp_path, rows):
    store = KeyedTable(spark, str(tmp_path / "flat"), ["k"])
    store.merge(batch(spark, ("a", 1, 1.0)))
    store.merge(batch(spark, ("b", 1, 2.0), ("c", 2, 3.0)))
    assert rows(store.read()) == [("b", 1, 2.0), ("c", 2, 3.0)]


def test_partition_must_come_from_the_key(spark, tmp_path):
    store = KeyedTable(spark, str(tmp_path / "t"), ["k"], F.substring("day", 1, 4))
    with pytest.raises(Exception, match="day"):
        store.merge(batch(spark, ("2020-01-01", 1, 1.0)))


def test_any_partition_value(spark, tmp_path, rows):
    store = KeyedTable(spark, str(tmp_path / "t"), ["day"], F.col("day"))
    odd = ["a/b", "new york", "", "ü=%20{x}*?", "none", "2020", "02020", "__HIVE_DEFAULT_PARTITION__x"]
    store.merge(batch(spark, *[(d, i, 1.0) for i, d in enumerate(odd)], (None, 9, 1.0)))
    before = files(store)
    store.merge(batch(spark, ("a/b", 0, 2.0), ("new york", 1, 1.0), ("ü=%20{x}*?", 3, 5.0)))
    assert {r["day"]: r["v"] for r in store.read().collect()} == dict.fromkeys([*odd, None], 1.0) | {"a/b": 2.0, "ü=%20{x}*?": 5.0}
    after = files(store)
    assert sum(after[k] != before[k] for k in before) == 3


days = st.sampled_from(["2020-01-01", "2020-02-01", "2021-01-01", "2022-01-01"])
deliveries = st.lists(
    st.dictionaries(st.tuples(days, st.integers(0, 2)), st.integers(0, 99), min_size=1, max_size=5),
    min_size=2,
    max_size=4,
)


@settings(max_examples=5, deadline=None)
@given(deliveries)
def test_property_merges_are_dictionary_updates(spark, tmp_path_factory, batches):
    store = KeyedTable(
        spark, str(tmp_path_factory.mktemp("p") / "table"), ["day", "k"], F.substring("day", 1, 4)
    )
    expected = {}
    for delivery in batches:
        data = [(day, k, float(v)) for (day, k), v in delivery.items()]
        store.merge(batch(spark, *data))
        expected |= delivery
        assert {(r["day"], r["k"]): int(r["v"]) for r in store.read().collect()} == expected


def test_view(store, spark):
    store.merge(batch(spark, ("2020-01-01", 1, 1.5)))
    store.register_view("stored")
    assert spark.sql("SELECT sum(v) FROM stored").head()[0] == 1.5


def test_feed_run_from_files(spark, tmp_path, rows):
    """A delivered file, its correction, and the same file again."""
    path = tmp_path / "market.tsv"
    header = "period_begin\tperiod_end\tregion_type\tregion_type_id\tregion_name\tregion_id\tduration\tmedian_sale_price\tnote\n"
    row = "{0}\t2023-01-07\tcounty\t5\tKing County, WA\t1\t1 weeks\t{1}\tn\n"
    path.write_text(header + row.format("2023-01-01", 100) + row.format("2022-12-25", 90) + row.format("2023-01-01", 100))
    store = feeds.FEEDS["market_weekly"].store(spark, str(tmp_path / "table"))
    feeds.run(spark, "market_weekly", str(path), store, as_of="2024-02-01")
    assert rows(store.read(), "county_name", "median_sale_price") == [("king", 100.0), ("king", 90.0)]
    assert store.partitions() == ["2022", "2023"]

    fix = tmp_path / "fix.tsv"
    fix.write_text(header + row.format("2023-01-01", 120))
    for _ in range(2):
        feeds.run(spark, "market_weekly", str(fix), store, as_of="2024-02-08")
    assert rows(store.read(), "period_begin", "median_sale_price", "processed_date", "note").__len__() == 2
    latest = store.read().where("period_begin = '2023-01-01'").head()
    assert (latest["median_sale_price"], str(latest["processed_date"])) == (120.0, "2024-02-08")


def test_a_load_parses_its_input_once_and_counts_what_it_finds(spark, tmp_path, rows):
    """Every raw row passes the parser once, whatever is made of it: rows, rejects, counts."""
    spec = feeds.FEEDS["places"]
    names = "address string, name string, postal_code string, city string, state string, stars string, _corrupt_record string, _arrived string"
    raw = [(f"a{i}", "n", f"{i:05d}" if i % 5 else "U1", "c", "s", "4" if i % 3 else "many", None, "1") for i in range(60)]
    raw += [(None, None, None, None, None, None, "{bad", "1")] * 2
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    df = spark.createDataFrame(raw, names).mapInArrow(counting, names)
    store = spec.store(spark, str(tmp_path / "t"))
    done = feeds.load(spec, [df], store, "first", as_of="2024-02-01")
    assert passed.value == 62
    assert done.counts == {
        "rows": 62, "rejected": 30, "corrupt": 2, "type:stars": 20, "rule:stars": 20, "rule:postal_code": 12
    }
    kept = spark.read.parquet(f"{store.root}/rejects/first")
    found = kept.groupBy(F.array_join("reasons", ",")).count()
    assert rows(found) == [
        ("corrupt", 2), ("rule:postal_code", 8), ("type:stars,rule:stars", 16), ("type:stars,rule:stars,rule:postal_code", 4)
    ]
    assert store.read().count() == 32
    feeds.load(spec, [df], store, "first", as_of="2024-02-01")
    assert spark.read.parquet(f"{store.root}/rejects/*").count() == 30
