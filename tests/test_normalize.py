from datetime import date

import pytest
from pyspark.sql import functions as F

from areafacts.functions import normalize as N


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression.alias("y")).head()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("King County", "king"),
        ("X COUNTY", "x"),
        ("King County ", "king county"),  # the suffix goes before the spaces
        ("  Los Angeles county", "los angeles"),
        ("Orleans Parish", "orleans parish"),
        ("County", "county"),
        ("\tKing County", "\tking"),
        (None, None),
    ],
)
def test_county(spark, text, expected):
    assert one(spark, text, N.county("x")) == expected


def test_county_with_other_suffixes(spark):
    assert one(spark, "Orleans Parish", N.county("x", ("parish",))) == "orleans"
    assert one(spark, "Nome Borough", N.county("x", ("parish", "borough"))) == "nome"
    assert one(spark, "King County", N.county("x", ("parish", "borough"))) == "king county"


@pytest.mark.parametrize(
    "text, expected",
    [("  New York ", "new york"), ("\tNY", "\tny"), ("   ", ""), (None, None)],
)
def test_label(spark, text, expected):
    assert one(spark, text, N.label("x")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("King County, WA", ("king", "wa")),
        ("Nowhere", ("nowhere", None)),
        ("A County, B, C", ("a", "b")),
        (",", ("", "")),
        (None, (None, None)),
    ],
)
def test_split_region(spark, text, expected):
    assert tuple(one(spark, text, F.struct(*N.split_region("x")))) == expected


@pytest.mark.parametrize(
    "text, expected", [("00501", 501), ("99999999999", None), ("abc", None), ("10001\n", 10001), (None, None)]
)
def test_zip_to_int(spark, text, expected):
    assert one(spark, text, N.zip_to_int("x")) == expected


def test_zip5_keeps_long_codes(spark):
    df = spark.createDataFrame([(501,), (10001,), (1234567,), (None,)], "x int")
    assert [r[0] for r in df.select(N.zip5("x")).collect()] == ["00501", "10001", "1234567", None]


def test_to_double(spark):
    assert one(spark, "1.5", N.to_double("x")) == 1.5
    assert one(spark, "n/a", N.to_double("x")) is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2023-01-31", date(2023, 1, 31)),
        ("01/31/2023", date(2023, 1, 31)),
        ("31.01.2023", None),
        ("2023-02-30", None),
        (None, None),
    ],
)
def test_to_date_any(spark, text, expected):
    assert one(spark, text, N.to_date_any("x", ["yyyy-MM-dd", "MM/dd/yyyy"])) == expected


def test_stamp(spark):
    df = spark.range(1)
    assert N.stamp(df, "2024-02-01").head()["processed_date"] == date(2024, 2, 1)
    assert N.stamp(df, date(2024, 2, 1)).head()["processed_date"] == date(2024, 2, 1)
    today = N.stamp(df, name="seen").select((F.col("seen") == F.current_date()).alias("same"))
    assert today.head()["same"]
