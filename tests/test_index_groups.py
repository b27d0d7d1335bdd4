"""Deliveries of the wide index with different headers, cleaned together."""

from pyspark.sql import functions as F

from areafacts.plans import feeds
from tests.conftest import plan_of

_IDS = "RegionID string, SizeRank string, RegionName string, RegionType string, StateName string, State string, CountyName string"


def _index(spark, months, arrived, *rows):
    cells = [(*[str(x) for x in (region, 1, region, "zip", "Washington", " WA", "King County")], *values, arrived) for region, *values in rows]
    schema = ", ".join([_IDS, *[f"`{m}` string" for m in months], "_arrived string"])
    return spark.createDataFrame(cells, schema)


def test_indexes_of_different_months_meet_while_wide(spark):
    feed = feeds.FEEDS["value_index"]
    old = _index(spark, ["2023-01-31", "2023-02-28"], "1", (1, "10", "11"), (2, "20", "21"))
    new = _index(spark, ["2023-02-28", "2023-03-31"], "2", (1, None, "13"), (3, "32", "x"))
    newest = _index(spark, ["2023-01-31"], "3", (2, "99"))
    found = feeds.cleaned(feed, [old, new, newest])
    assert "_arrived" not in found.columns
    expected = [
        (1, "wa", "2023-01-31", 10.0),
        (1, "wa", "2023-02-28", None),  # the later file has the month, and no value
        (1, "wa", "2023-03-31", 13.0),
        (2, "wa", "2023-01-31", 99.0),
        (2, "wa", "2023-02-28", 21.0),
        (3, "wa", "2023-02-28", 32.0),
        (3, "wa", "2023-03-31", None),
    ]
    got = sorted((tuple(r) for r in found.select("RegionID", "state_id", "Date", "Value").collect()), key=lambda r: (r[0], r[2]))
    assert got == expected
    assert "Date" not in "".join(line for line in plan_of(found).splitlines() if "Exchange" in line or "Window" in line)


def test_options_hold_for_indexes_of_different_months(spark):
    feed = feeds.FEEDS["value_index"]
    old = _index(spark, ["2023-01-31", "2023-02-28"], "1", (1, "10", "11"))
    new = _index(spark, ["2023-02-28", "2023-03-31"], "2", (1, None, "13")).withColumn("Extra", F.lit("e"))
    pick = lambda df: sorted(tuple(r) for r in df.select("Date", "Value").collect())
    assert pick(feeds.cleaned(feed, [old, new], dates_from="2023-02")) == [("2023-02-28", None), ("2023-03-31", 13.0)]
    # a null counts for nothing here, so the older file's value stays
    known = [("2023-01-31", 10.0), ("2023-02-28", 11.0), ("2023-03-31", 13.0)]
    assert pick(feeds.cleaned(feed, [old, new], drop_nulls=True)) == known
    whole = feeds.cleaned(feed, [old, new], stamped=True, as_of="2024-01-01")
    assert whole.columns[-4:] == ["Date", "Value", "processed_date", "Extra"]
