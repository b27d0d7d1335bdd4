from datetime import date

import pytest
from pyspark.sql import functions as F

from areafacts.operators import reshape
from tests.conftest import plan_of


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [(1, 9.0, 10, 1.5), (2, None, 20, None)],
        "id int, `1999-12-31` double, `2000-01-31` int, `2000-02-29` double",
    )


def test_split_columns(wide):
    assert reshape.split_columns(wide.columns) == (["id", "1999-12-31"], ["2000-01-31", "2000-02-29"])


def test_long_rows_keep_nulls_and_old_columns(wide, rows):
    out = reshape.wide_to_long(wide)
    assert out.columns == ["id", "1999-12-31", "Date", "Value"]
    assert dict(out.dtypes)["Value"] == "double"
    assert set(rows(out, "id", "Date", "Value")) == {
        (1, "2000-01-31", 10.0),
        (1, "2000-02-29", 1.5),
        (2, "2000-01-31", 20.0),
        (2, "2000-02-29", None),
    }


def test_options(wide, rows):
    assert reshape.wide_to_long(wide, drop_nulls=True).count() == 3
    assert rows(reshape.wide_to_long(wide, dates_from="2000-02"), "id", "Value") == [(1, 1.5), (2, None)]
    assert rows(reshape.wide_to_long(wide, dates_to="2000-01-31"), "id", "Value") == [(1, 10.0), (2, 20.0)]
    assert reshape.wide_to_long(wide, as_date=True).agg(F.max("Date")).head()[0] == date(2000, 2, 29)
    assert reshape.wide_to_long(wide, names=("d", "v")).columns[-2:] == ["d", "v"]


def test_no_value_column(wide):
    with pytest.raises(ValueError, match="no value column"):
        reshape.wide_to_long(wide.select("id"))
    with pytest.raises(ValueError, match="no value column"):
        reshape.wide_to_long(wide, dates_from="2005")


def test_very_wide_equals_narrow(spark, rows):
    """The two plans, chosen by the number of columns, give the same rows."""
    df = spark.range(7).select(
        "id",
        *[F.when(F.col("id") != i % 5, F.col("id") * i).alias(f"20{i:03d}") for i in range(150)],
    )
    out = reshape.wide_to_long(df)
    assert "Generate inline" in plan_of(out) and "Expand" not in plan_of(out)
    spark.conf.set("spark.sql.codegen.maxFields", "1000")
    try:
        narrow = reshape.wide_to_long(df)
    finally:
        spark.conf.unset("spark.sql.codegen.maxFields")
    assert "Expand" in plan_of(narrow)
    assert out.dtypes == narrow.dtypes
    assert rows(out) == rows(narrow)
    assert out.count() == 7 * 150


def test_rename_required(wide):
    assert reshape.rename_required(wide, {"ID": "key"}).columns[0] == "key"
    with pytest.raises(ValueError, match="nope"):
        reshape.rename_required(wide, {"nope": "x"})


def test_odd_column_names(spark, rows):
    """Quotes, backticks, dots and backslashes in names survive both plans."""
    odd = ["20'a", "20`b", "20.c", "20\\d", '20"e']
    for extra in (0, 120):
        names = odd + [f"20x{i}" for i in range(extra)]
        df = spark.createDataFrame([(1, *map(str, range(len(names))))], ["the id", *names])
        out = {r["Date"]: r["Value"] for r in reshape.wide_to_long(df).collect()}
        assert out == {n: float(i) for i, n in enumerate(names)}


def test_text_that_is_no_number_is_null(spark):
    df = spark.createDataFrame([("1.5", "n/a")], "`2000-01-31` string, `2000-02-29` string")
    assert {r["Date"]: r["Value"] for r in reshape.wide_to_long(df).collect()} == {
        "2000-01-31": 1.5,
        "2000-02-29": None,
    }


def test_both_forms_of_the_unpivot_have_one_schema(spark):
    from areafacts.operators.reshape import wide_to_long

    def wide(months):
        return spark.range(2).select("id", *[F.when(F.col("id") > 0, 1.0).alias(f"20{m:03d}") for m in range(months)])

    narrow, broad = (wide_to_long(wide(n)).schema for n in (3, 150))
    assert narrow == broad
