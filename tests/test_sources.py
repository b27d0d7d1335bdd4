import os

import pytest
from pyspark.sql import types as T

from areafacts import schemas as S
from areafacts import scratch
from areafacts.operators.reshape import wide_to_long
from areafacts.plans import feeds
from areafacts.sources import readers, tables
from tests.conftest import plan_of

SCHEMA = T.StructType().add("day", "date").add("n", "integer").add("x", "double")


def test_columns_are_matched_by_name(spark, tmp_path, rows):
    (tmp_path / "a.tsv").write_text("x\tother\tday\tn\n1.5\to\t2023-01-31\t7\n\t\tn/a\tseven\n")
    df = readers.read_delimited(spark, str(tmp_path / "a.tsv"), SCHEMA, sep="\t")
    assert df.columns == ["x", "other", "day", "n"]
    assert [tuple(map(str, r)) for r in df.collect()] == [("1.5", "o", "2023-01-31", "7"), ("None",) * 4]
    assert readers.read_delimited(spark, str(tmp_path / "a.tsv"), SCHEMA, sep="\t", extra="drop").columns == [
        "x",
        "day",
        "n",
    ]


def test_quoted_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,day,x\n1,2023-01-01,2\n"2","2023-01-02","3"\n')
    assert readers.read_delimited(spark, str(tmp_path / "a.csv"), SCHEMA).count() == 2


def test_another_header_in_the_folder_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("day,n,x\n2023-01-01,1,2\n")
    (tmp_path / "b.csv").write_text("n,day,x\n1,2023-01-01,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_delimited(spark, str(tmp_path), SCHEMA).collect()


def test_inference_is_opt_in(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip,day\n00501,2023-01-31\n")
    df = readers.read_delimited(spark, str(tmp_path / "a.csv"), None)
    assert df.dtypes == [("zip", "int"), ("day", "date")]
    assert df.head()["zip"] == 501


def test_missing_input_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not.*exist"):
        readers.read_delimited(spark, str(tmp_path / "none.csv"), SCHEMA)


def test_json_lines(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"name": "a", "stars": 4.5, "review_count": 3, "attributes": {"x": {"y": 1}}, "hours": null}\n'
        "{not json\n"
        '{"name": "b", "stars": "bad"}\n'
    )
    df = readers.read_json_lines(spark, str(tmp_path / "p.json"), S.RAW_PLACE)
    got = {r["name"]: (r["stars"], r["review_count"], r["_corrupt_record"]) for r in df.collect()}
    assert got["a"] == (4.5, 3, None)
    assert got[None][2] == "{not json"
    assert "attributes" not in df.columns


def test_places_from_json(spark, tmp_path, rows):
    (tmp_path / "p.json").write_text(
        '{"address": "1 Main", "name": "a", "city": " Rome ", "state": "NY", "stars": 4.0, "postal_code": "13440",'
        ' "review_count": 2, "categories": "Restaurants", "attributes": {"a": "b"}, "is_open": 1}\n{oops\n'
    )
    spec = feeds.FEEDS["places"]
    out = feeds.cleaned(spec, spec.read(spark, str(tmp_path / "p.json")), as_of="2024-02-01")
    assert out.columns == S.PLACE.names
    assert rows(out, "name", "city", "zip_int") == [("a", "rome", 13440)]


def test_wide_index(spark, tmp_path, rows):
    (tmp_path / "w.csv").write_text(
        "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,1999-12-31,2000-01-31,2000-02-29\n"
        "1,1,501,zip,NY,NY,Holtsville,New York,Suffolk County,7,100,200.5\n"
        "2,2,544,zip,NY,NY,Holtsville,New York,Suffolk County,7,,x\n"
    )
    df = readers.read_wide_index(spark, str(tmp_path / "w.csv"), S.RAW_VALUE_IDS)
    types = dict(df.dtypes)
    assert (types["RegionID"], types["1999-12-31"], types["2000-01-31"]) == ("int", "string", "double")
    assert rows(wide_to_long(df), "RegionID", "Date", "Value") == [
        (1, "2000-01-31", 100.0),
        (1, "2000-02-29", 200.5),
        (2, "2000-01-31", None),
        (2, "2000-02-29", None),
    ]
    spec = feeds.FEEDS["value_index"]
    clean = feeds.cleaned(spec, spec.read(spark, str(tmp_path / "w.csv")), dates_from="2000-02")
    assert rows(clean, "RegionID", "county_name", "Date") == [(1, "suffolk", "2000-02-29"), (2, "suffolk", "2000-02-29")]


def test_unwanted_months_are_not_read(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.range(3).selectExpr("id", "1.0D AS `2000-01-31`", "2.0D AS `2000-02-29`").write.parquet(path)
    plan = plan_of(wide_to_long(spark.read.parquet(path), dates_from="2000-02"))
    assert "ReadSchema: struct<id:bigint,2000-02-29:double>" in plan


def test_catalog_target(spark, rows):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tables.ensure_target(df, "made") is True
    assert tables.ensure_target(df, "made") is False
    assert spark.table("made").dtypes == df.dtypes
    assert spark.table("made").count() == 0


def test_plain_parquet_table_refuses_merge(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.ensure_target(df, "plain")
    with pytest.raises(Exception, match="(?i)merge|row-level|unsupported"):
        tables.merge_into(df, "plain", ["k"])


def test_view(spark):
    tables.register_view(spark.range(3), "three")
    assert spark.sql("SELECT count(*) FROM three").head()[0] == 3


def test_scratch_uses_the_shared_folder(spark):
    assert scratch.folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.folder(spark, "x") != scratch.folder(spark, "x")


def test_market_schema_has_all_metric_pairs():
    assert len(S.MARKET.fields) == 3 + 32 + 3
    assert S.RAW_MARKET["active_listings"].dataType == T.IntegerType()
    assert S.RAW_MARKET["active_listings_yoy"].dataType == T.DoubleType()


def test_whole_numbers_with_a_fraction_of_zero(spark, tmp_path, rows):
    (tmp_path / "m.tsv").write_text(
        "period_begin\tperiod_end\tregion_type_id\tregion_name\tactive_listings\n"
        "2023-01-01\t2023-01-07\t5.0\tKing County, WA\t7.0\n2023-01-01\t2023-01-07\t5\tPike County, WA\t7.5\n"
    )
    spec = feeds.FEEDS["market_weekly"]
    groups = spec.read(spark, str(tmp_path / "m.tsv"))
    assert rows(feeds.cleaned(spec, groups), "county_name", "active_listings") == [("king", 7), ("pike", None)]
    assert [(r["reasons"], "7.5" in r["row"]) for r in feeds.rejects(spec, groups[0]).collect()] == [(["type:active_listings"], True)]
    typed = readers.read_delimited(spark, str(tmp_path / "m.tsv"), S.RAW_MARKET, sep="\t")
    assert rows(typed, "region_type_id") == [(5,), (5,)]


def test_rejected_places_keep_what_was_delivered(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"address": "1", "name": "a", "city": "c", "state": "NY", "stars": "many", "postal_code": "00501"}\n'
        '{"address": "2", "name": "b", "city": "c", "state": "NY", "stars": 9, "postal_code": "x"}\n'
        '{"address": "3", "name": "c", "city": "c", "state": "NY", "stars": 3, "postal_code": "1", "review_count": 5.0}\n{oops\n'
    )
    spec = feeds.FEEDS["places"]
    (group,) = spec.read(spark, str(tmp_path / "p.json"))
    found = sorted((r["reasons"], r["row"]) for r in feeds.rejects(spec, group).collect())
    assert [reasons for reasons, _ in found] == [["corrupt"], ["rule:stars", "rule:postal_code"], ["type:stars", "rule:stars"]]
    assert found[0][1] == "{oops" and '"stars":"many"' in found[2][1]
    assert [r["review_count"] for r in feeds.cleaned(spec, [group]).collect()] == [5]


def test_wide_files_with_different_months(spark, tmp_path, rows):
    ids = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName"
    line = ",1,501,zip,NY,NY,Holtsville,New York,Suffolk County,"
    for n, (name, months, values) in enumerate(
        [("a.csv", "2000-01-31", {1: "1", 2: "2"}), ("b.csv", "2000-01-31,2000-02-29", {1: "10,20"}), ("c.csv", "2000-02-29", {2: "x"})]
    ):
        path = tmp_path / name
        path.write_text(f"{ids},{months}\n" + "".join(f"{i}{line}{v}\n" for i, v in values.items()))
        os.utime(path, (1_000_000 + n, 1_000_000 + n))
    spec = feeds.FEEDS["value_index"]
    groups = spec.read(spark, str(tmp_path))
    assert len(groups) == 3
    assert rows(feeds.cleaned(spec, groups), "RegionID", "Date", "Value") == [
        (1, "2000-01-31", 10.0), (1, "2000-02-29", 20.0), (2, "2000-01-31", 2.0), (2, "2000-02-29", None)
    ]
    store = spec.store(spark, str(tmp_path / "table"))
    feeds.run(spark, spec, str(tmp_path) + "/*.csv", store)
    kept = spark.read.parquet(f"{store.root}/rejects/*")
    assert [r["reasons"] for r in kept.collect()] == [["type:2000-02-29"]]
