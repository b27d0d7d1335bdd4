"""The four feeds on small raw frames with explicit schemas.

The rows and what must come of them are fixed values (FIXTURES.md).
"""

from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from areafacts import schemas as S
from areafacts.plans import feeds

DAY = "2024-02-01"


@pytest.fixture
def raw_market(spark):
    schema = (
        "period_begin date, period_end date, region_type_id int, region_name string, region_type string, duration string"
    )
    king = (date(2023, 1, 1), date(2023, 1, 7), 5, "King County, WA", "county", "1week")
    return spark.createDataFrame(
        [
            king,
            (date(2023, 1, 8), date(2023, 1, 14), 5, "Los Angeles County, CA", "county", "1week"),
            king,
            (date(2023, 1, 15), date(2023, 1, 21), 6, "Seattle, WA", "city", "1week"),
        ],
        schema,
    )


def test_market_weekly(raw_market, rows):
    out = feeds.market_weekly(raw_market, DAY)
    assert sorted(out.columns) == sorted(
        ["period_begin", "period_end", "duration", "county_name", "state_id", "processed_date"]
    )
    assert out.schema["period_begin"].dataType == T.DateType()
    assert out.schema["county_name"].dataType == T.StringType()
    assert out.schema["processed_date"].dataType == T.DateType()
    assert rows(out, "county_name", "state_id") == [("king", "wa"), ("los angeles", "ca")]


def test_market_weekly_other_region_type(raw_market, rows):
    assert rows(feeds.market_weekly(raw_market, DAY, region_type=6), "county_name", "state_id") == [("seattle", "wa")]


def test_market_without_a_comma_or_name(spark, rows):
    raw = spark.createDataFrame(
        [(5, "Nowhere", date(2023, 1, 1), date(2023, 1, 7)), (5, None, date(2023, 1, 1), date(2023, 1, 7)),
         (None, "Lost County, WA", date(2023, 1, 1), date(2023, 1, 7))],
        "region_type_id int, region_name string, period_begin date, period_end date",
    )
    assert rows(feeds.market_weekly(raw), "county_name", "state_id") == [(None, None), ("nowhere", None)]


@pytest.fixture
def raw_area(spark):
    extra = tuple("123456789")
    la = (12345, 34.0522, -118.2437, "Los Angeles", "CA", "California", 10000, 100.0, "Los Angeles County", *extra)
    ny = (67890, 40.7128, -74.0060, "New York", "NY", "New York", 20000, 200.0, "New York County", *extra)
    return spark.createDataFrame([la, ny, la], S.RAW_AREA)


def test_area_reference(raw_area, rows):
    out = feeds.area_reference(raw_area, DAY)
    assert sorted(out.columns) == sorted(S.AREA.names)
    assert out.schema["zip"].dataType == T.IntegerType()
    assert out.schema["processed_date"].dataType == T.DateType()
    assert rows(out, "zip", "county_name", "state_id") == [(12345, "los angeles", "ca"), (67890, "new york", "ny")]


PLACE_SCHEMA = T.StructType(
    [
        *S.RAW_PLACE.fields,
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("business_id", T.StringType()),
        T.StructField("hours", T.MapType(T.StringType(), T.StringType())),
        T.StructField("is_open", T.IntegerType()),
    ]
)


def place(address="123 Main St", categories="Restaurants, Italian", city="New York", name="Italian Place",
          postal_code="10001", review_count=100, stars=4.5, state="NY"):
    return (address, categories, city, 40.7128, -74.0060, name, postal_code, review_count, stars, state,
            {"WiFi": "free"}, "1", {"Monday": "9:00-22:00"}, 1)


def test_places(spark, rows):
    raw = spark.createDataFrame(
        [
            place(),
            place("456 Oak Ave", "Shopping, Books", "Los Angeles", "Book Store", "90001", 50, 3.0, "CA"),
            place(),
            place("789 Pine Ln", "Cafe", "Seattle", "Coffee Shop", "abc", 75, 4.0, "WA"),
        ],
        PLACE_SCHEMA,
    )
    out = feeds.places(raw, DAY)
    assert sorted(out.columns) == sorted(S.PLACE.names)
    assert out.schema["stars"].dataType == T.DoubleType()
    assert out.schema["zip_int"].dataType == T.IntegerType()
    assert out.schema["processed_date"].dataType == T.DateType()
    assert rows(out, "city", "state", "zip_int") == [("los angeles", "ca", 90001), ("new york", "ny", 10001)]


def test_place_edges(spark, rows):
    raw = spark.createDataFrame(
        [
            place("zip plus four", postal_code="10001-1234"),
            place("empty zip", postal_code=""),
            place("null zip", postal_code=None),
            place("low", stars=0.5),
            place("high", stars=5.5),
            place("unrated", stars=None),
            place("nameless", name=None),
            place("no city", city=None),
            place("no state", state=None),
            place("leading zero", postal_code="00501"),
            place("overflow", postal_code="99999999999"),
            place("lowest", stars=1.0),
            place("highest", stars=5.0),
            place("blank city", city="   "),
        ],
        PLACE_SCHEMA,
    )
    assert rows(feeds.places(raw, DAY), "address", "zip_int", "city") == [
        ("blank city", 10001, ""),
        ("highest", 10001, "new york"),
        ("leading zero", 501, "new york"),
        ("lowest", 10001, "new york"),
        ("overflow", None, "new york"),
    ]
    rejected = {r["address"]: r["reasons"] for r in feeds.rejected_places(raw).collect()}
    assert rejected == {
        "zip plus four": ["postal_code"],
        "empty zip": ["postal_code"],
        "null zip": ["postal_code"],
        "low": ["stars"],
        "high": ["stars"],
        "unrated": ["stars"],
        "nameless": ["name"],
        "no city": ["city"],
        "no state": ["state"],
    }


@pytest.fixture
def raw_values(spark):
    schema = T.StructType(
        [*S.RAW_VALUE_IDS.fields, *[T.StructField(c, T.DoubleType()) for c in ("2023-01-31", "2023-02-28")]]
    )
    la = (1, 1, 12345, "Zip", "CA", "CA", "Los Angeles", "Los Angeles-Long Beach-Anaheim", "Los Angeles County",
          100000.0, 101000.0)
    ny = (2, 2, 67890, "Zip", "NY", "NY", "New York", "New York-Newark-Jersey City", "New York County",
          200000.0, 202000.0)
    return spark.createDataFrame([la, ny, la], schema)


def test_value_index(raw_values, rows):
    out = feeds.value_index(raw_values)
    assert out.columns == S.VALUE.names
    assert out.schema["RegionID"].dataType == T.IntegerType()
    assert out.schema["Date"].dataType == T.StringType()
    assert out.schema["Value"].dataType == T.DoubleType()
    assert rows(out, "RegionID", "state_id", "county_name", "Date", "Value") == [
        (1, "ca", "los angeles", "2023-01-31", 100000.0),
        (1, "ca", "los angeles", "2023-02-28", 101000.0),
        (2, "ny", "new york", "2023-01-31", 200000.0),
        (2, "ny", "new york", "2023-02-28", 202000.0),
    ]


def test_value_index_stamp_is_opt_in(raw_values):
    assert "processed_date" not in feeds.value_index(raw_values).columns
    assert "processed_date" not in feeds.value_index(raw_values, as_of=DAY).columns
    assert feeds.value_index(raw_values, as_of=DAY, stamped=True).head()["processed_date"] == date(2024, 2, 1)


def test_known_months_of_all_copies_are_kept(spark):
    """Copies of a region that know different months; the first in the order decides where both know one."""
    names = "RegionID int, RegionName int, State string, CountyName string, `2023-01-31` double, `2023-02-28` double, day int"
    rows = [(1, 501, "NY", "A County", 10.0, None, 1), (1, 501, " ny", "A County", 11.0, 20.0, 2)]
    wide = spark.createDataFrame(rows, names)
    found = feeds.value_index(wide, order_by=["day"], drop_nulls=True)
    assert sorted((r["Date"], r["Value"]) for r in found.collect()) == [("2023-01-31", 10.0), ("2023-02-28", 20.0)]


def test_survivors_are_the_same_in_every_run(spark, rows):
    columns = "zip int, lat double, city string, state_id string, county_name string"
    copies = [(i % 20, float(i), f"c{i}", "NY", "A County") for i in range(400)]
    found = [rows(feeds.area_reference(spark.createDataFrame(copies[::step], columns).repartition(n), DAY)) for step, n in ((1, 1), (-1, 7))]
    assert found[0] == found[1]


def test_value_index_needs_its_columns(raw_values):
    with pytest.raises(ValueError, match="State"):
        feeds.value_index(raw_values.drop("State"))


def test_value_index_keeps_one_row_per_region_and_month(raw_values, rows):
    """Rows of one region that differ only in how its state is written are one."""
    from pyspark.sql import functions as F

    other = raw_values.withColumn("State", F.concat(F.lit(" "), F.lower("State")))
    out = feeds.value_index(raw_values.union(other))
    assert out.count() == out.select(*S.VALUE_KEYS).distinct().count() == 4


# -- frames whose types were inferred: numbers are long, dates are text ---------------


def test_market_from_inferred_types(spark, rows):
    raw = spark.createDataFrame(
        [
            Row(period_begin="2023-01-01", period_end="2023-01-07", region_type_id=5, region_name="King County, WA"),
            Row(period_begin="bad", period_end="2023-01-14", region_type_id=5, region_name="Los Angeles County, CA"),
        ]
    )
    out = feeds.market_weekly(raw)
    assert out.schema["period_begin"].dataType == T.DateType()
    assert rows(out, "period_begin", "county_name") == [(None, "los angeles"), (date(2023, 1, 1), "king")]


def test_market_with_other_date_formats(spark, rows):
    raw = spark.createDataFrame(
        [("01/08/2023", "2023-01-14", 5, "A County, WA"), ("2023-01-01", "01/07/2023", 5, "B County, WA")],
        "period_begin string, period_end string, region_type_id int, region_name string",
    )
    out = feeds.market_weekly(raw, date_formats=["yyyy-MM-dd", "MM/dd/yyyy"])
    assert rows(out, "county_name", "period_begin", "period_end") == [
        ("a", date(2023, 1, 8), date(2023, 1, 14)),
        ("b", date(2023, 1, 1), date(2023, 1, 7)),
    ]


def test_areas_from_inferred_types(spark, rows):
    raw = spark.createDataFrame([Row(zip=12345, state_id="CA", county_name="Los Angeles County", population="10")])
    out = feeds.area_reference(raw)
    assert out.schema["zip"].dataType == out.schema["population"].dataType == T.IntegerType()
    assert rows(out, "zip", "county_name", "population") == [(12345, "los angeles", 10)]


def test_values_from_inferred_types(spark):
    raw = spark.createDataFrame(
        [(1, 12345, "CA", "Los Angeles County", 100000, "x")],
        "RegionID long, RegionName long, State string, CountyName string, `2023-01-31` long, `2023-02-28` string",
    )
    out = feeds.value_index(raw)
    assert out.schema["RegionID"].dataType == T.IntegerType()
    assert {r["Date"]: r["Value"] for r in out.collect()} == {"2023-01-31": 100000.0, "2023-02-28": None}


def test_places_from_inferred_types(spark, rows):
    raw = spark.createDataFrame(
        [("a", "n", "c", "NY", 10001, "4.5")],
        "address string, name string, city string, state string, postal_code long, stars string",
    )
    assert rows(feeds.places(raw), "postal_code", "zip_int", "stars") == [("10001", 10001, 4.5)]


def test_only_the_wanted_months_are_read_and_shuffled(spark, tmp_path):
    from tests.conftest import plan_of

    path = str(tmp_path / "wide")
    spark.range(4).selectExpr(
        "id AS RegionID", "id AS RegionName", "'NY' AS State", "'A County' AS CountyName",
        *[f"{m}.0D AS `2023-{m:02d}-28`" for m in range(1, 13)],
    ).write.parquet(path)
    plan = plan_of(feeds.value_index(spark.read.parquet(path), dates_from="2023-12"))
    read = plan[plan.index("ReadSchema"):]
    assert "2023-12-28" in read and "2023-11-28" not in read
    assert plan.count("Exchange") == 1
