"""Steps whose memory or shuffles grew faster than the tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from areafacts.plans import marts
from tests.conftest import plan_of
from workload import frames
from workload import queries as W


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers and their orders from January to April 1995; one order without a day, one without a price."""
    home = tmp_path_factory.mktemp("tables")
    made = {
        "region": [(0, "ASIA")],
        "nation": [(1, "INDIA", 0)],
        "customer": [(1, "one", 1, 10.0, "BUILDING"), (2, "two", 1, 20.0, "MACHINERY"), (3, "three", 1, None, None)],
        "orders": [
            (n, customer, "O", price, day and datetime.datetime(1995, day, 5), "1")
            for n, (customer, price, day) in enumerate(
                [(1, 1.5, 1), (1, 2.0, 3), (1, 2.5, 3), (1, 9.0, None), (2, None, 2), (2, 4.0, 4), (None, 5.0, 2), (77, 6.0, 2)]
            )
        ],
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, frames.SCHEMAS[name]).write.parquet(f"{home}/{name}.parquet")
    return str(home)


def test_months_meet_without_a_pivot(spark, tables, rows):
    wide = frames.raw_value_index(spark, tables)
    assert "pivotfirst" not in plan_of(wide).lower()
    months = ["1995-01-31", "2000-02-29", "2000-03-31", "2000-04-30"]
    assert wide.columns[-4:] == months
    found = rows(wide.select("RegionName", *[F.col(f"`{m}`") for m in months]))
    assert found == [(1, 1.5, None, 4.5, None), (2, None, None, None, 4.0), (3, None, None, None, None)]


def test_value_series_keeps_no_rows_in_a_hash_aggregate(spark):
    values = spark.createDataFrame(
        [(1, "wa", "2023-01-31", 1.0), (1, "wa", "2023-01-05", 2.0), (1, "wa", "2023-03-31", None), (2, "wa", "2023-02-28", 5.0)],
        "RegionName int, state_id string, Date string, Value double",
    )
    series = marts.value_series(values, "2023-01-01", "2023-03-31", partitions=3)
    plan = plan_of(series)
    assert "HashAggregate" not in plan and plan.count("Sort [") == 1
    assert "hashpartitioning(zip" in plan and ", 3), REPARTITION_BY_NUM" in plan
    found = {(r["zip"], str(r["month"])[:7]): (r["home_value"], r["known"], r["months_old"]) for r in series.collect()}
    assert found == {
        (1, "2023-01"): (1.5, True, 0),
        (1, "2023-02"): (1.5, False, 1),
        (1, "2023-03"): (1.5, False, 2),
        (2, "2023-01"): (None, False, None),
        (2, "2023-02"): (5.0, True, 0),
        (2, "2023-03"): (5.0, False, 1),
    }


def test_layouts_get_more_files_with_more_rows(spark, tables, tmp_path, monkeypatch):
    assert W._value_tasks(spark, tables, 16) == 16
    monkeypatch.setattr(W, "ROWS_A_TASK", 1)
    assert W._value_tasks(spark, tables, 2) == 12  # three customers, four months


def test_series_is_dealt_by_the_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(W, "ROWS_A_TASK", 1)
    assert ", 12), REPARTITION_BY_NUM" in plan_of(W.QUERIES["value_series"](spark, tables))
