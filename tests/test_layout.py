"""Stored layouts: joins without a shuffle, filters that skip what they do not need."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from areafacts.plans import marts
from areafacts.sources import tables
from workload import queries as W
from tests.conftest import plan_of

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"

pytestmark = pytest.mark.skipif(not os.path.isdir(LARGE), reason="driver tables are not here")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    home = f"{tmp_path_factory.mktemp('buckets')}/b-{uuid.uuid4().hex}"
    found = W._bucketed(spark, SF, home)
    yield found
    for df, what in zip(found, ("areas", "values", "places")):
        spark.sql(f"DROP TABLE IF EXISTS areafacts_{home.rsplit('-', 1)[-1]}_{what}")


def test_profile_of_bucketed_tables_has_no_shuffle(spark, stored, tmp_path):
    """The joins and groups by zip and state; the county market is small and broadcast."""
    own_areas, own_values, own_places = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = marts.area_places(marts.area_values(own_areas, own_values), own_places)
        plan = plan_of(joined)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "Bucketed: true" in plan
        plain = plan_of(marts.area_places(marts.area_values(W.areas(spark, SF), W.values(spark, SF)), W.places(spark, SF)))
        assert plain.count("Exchange hashpartitioning") > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    W.market(spark, SF).where("period_begin < '1995-03-01'").write.parquet(str(tmp_path / "market"))
    county = spark.read.parquet(str(tmp_path / "market"))
    profile = plan_of(marts.area_profile(own_areas, own_values, county, own_places))
    above, _, below = profile.partition("BroadcastExchange")
    assert below and "Exchange" not in above  # what follows is the market's own side


def test_clustered_files_let_the_drill_down_skip(spark, tmp_path):
    """At sf0.1 one zip is in one of 16 files; with several row groups a file, in at most 2 of all."""
    path = str(tmp_path / "values")
    tables.save_clustered(W.values(spark, LARGE), path, "RegionName", files=16, distinct=2_000, group_bytes=256 * 1024)
    groups = tables.row_groups(spark, path, "RegionName").collect()
    assert len(groups) >= 16 and sum(g["n_rows"] for g in groups) == W.values(spark, LARGE).count()
    hit = [g for g in groups if g["low"] <= 8 <= g["high"]]
    assert 1 <= len(hit) <= 2 and len(hit) / len(groups) <= 0.125
    drilled = spark.read.schema(W.values(spark, LARGE).schema).parquet(path).where("RegionName = 8")
    assert "EqualTo(RegionName,8)" in plan_of(drilled)
    assert drilled.count() == W.values(spark, LARGE).where("RegionName = 8").count()
    everything = spark.read.schema(W.values(spark, LARGE).schema).parquet(path)
    assert everything.exceptAll(W.values(spark, LARGE)).isEmpty()


def test_bloom_filters_are_written(spark, tmp_path):
    import pyarrow.parquet as pq

    sizes = {}
    for distinct in (None, 5_000):
        path = str(tmp_path / f"b{distinct}")
        tables.save_clustered(spark.range(20_000).select((F.col("id") * 3).alias("zip")), path, "zip", files=2, distinct=distinct)
        files = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")]
        assert len(files) == 2
        sizes[distinct] = sum(os.path.getsize(f) for f in files)
    # about 1 to 2 bytes for each expected value and file
    assert sizes[5_000] - sizes[None] >= 2 * 5_000
    assert sum(pq.read_metadata(f).num_rows for f in files) == 20_000
    assert spark.read.parquet(path).where("zip = 7").isEmpty()


def test_price_ranges_skip(spark, tmp_path):
    latest = marts.latest_value(W.values(spark, LARGE))
    path = str(tmp_path / "latest")
    tables.save_clustered(latest, path, "home_value", files=16)
    groups = tables.row_groups(spark, path, "home_value").collect()
    hit = [g for g in groups if g["low"] <= 110_000 and g["high"] >= 100_000]
    assert 0 < len(hit) <= len(groups) / 4
