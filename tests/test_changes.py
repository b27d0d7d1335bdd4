"""Change sets and the marts that follow them."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areafacts.operators.changes import changes
from areafacts.operators.upsert import upsert
from areafacts.plans import marts, upkeep
from areafacts.sources.keyed import KeyedTable
from tests.conftest import plan_of

SCHEMA = "k int, v string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_replaced_new_equal_and_keyless_rows(spark, rows):
    target = frame(spark, (1, "a"), (2, "b"), (3, None), (None, "n"))
    source = frame(spark, (1, "x"), (2, "b"), (3, "c"), (4, None), (None, "n"))
    assert rows(changes(target, source, ["k"])) == rows(
        spark.createDataFrame(
            [(-1, 1, "a"), (1, 1, "x"), (-1, 3, None), (1, 3, "c"), (1, 4, None), (1, None, "n")], "sign int, k int, v string"
        )
    )
    assert rows(changes(target, source, ["k"], null_safe=True).where("k IS NULL")) == []
    assert changes(target, frame(spark), ["k"]).count() == 0


data = st.dictionaries(st.integers(0, 5), st.sampled_from("abc"), max_size=6)


@settings(max_examples=8, deadline=None)
@given(data, data)
def test_property_target_and_changes_make_the_merged_table(spark, old, new):
    target, source = frame(spark, *old.items()), frame(spark, *new.items())
    signed = target.select(F.lit(1).alias("sign"), "*").union(changes(target, source, ["k"]))
    left = signed.groupBy("k", "v").agg(F.sum("sign").alias("n")).where("n <> 0")
    assert {tuple(r) for r in left.collect()} == {(*r, 1) for r in upsert(target, source, ["k"]).collect()}


PLACE = "address string, name string, postal_code string, zip_int int, state string, categories string, stars double, review_count long"


def place(i, zip_int, stars, reviews, state="ny", categories="Restaurants, Bars"):
    return (f"a{i}", "n", f"{zip_int or 0:05d}", zip_int, state, categories, stars, reviews)


@pytest.fixture
def tables(spark, tmp_path):
    base = KeyedTable(spark, str(tmp_path / "base"), ["address", "name", "postal_code"], F.substring("postal_code", 1, 2))
    mart = upkeep.place_mart()
    return base, mart, mart.state(spark, str(tmp_path / "mart"))


DELIVERIES = [
    [place(1, 501, 4.0, 10), place(2, 501, None, 5), place(3, 502, 1.5, 0, categories=None), place(4, None, 2.0, 1, None)],
    [place(1, 501, 0.1, 7, categories="Cafe"), place(2, 501, 0.2, 5), place(5, 503, 5.0, 2)],
    [place(3, 502, 1.5, 0, "nj", None), place(5, 503, 5.0, 2), place(6, 501, 0.3, 1)],
    [],
]


def summary(df):
    columns = ["zip", "state_id", "places", "category_places", "mean_stars", "weighted_stars", "category_stars"]
    return {(r[0], r[1]): r[2:4] + tuple(x if x is None else round(x, 9) for x in r[4:]) for r in (tuple(r) for r in df.select(*columns).collect())}


def test_a_mart_follows_its_deliveries(spark, tables):
    base, mart, state = tables
    for n, delivery in enumerate(DELIVERIES):
        mart.follow(base, state, spark.createDataFrame(delivery, PLACE), f"d{n}")
        assert summary(mart.read(state)) == summary(marts.place_summary(base.read()))
    assert (502, "ny") not in summary(mart.read(state))  # its only place moved


def test_a_delivery_that_was_cut_short_is_taken_up_where_it_was(spark, tables, monkeypatch):
    base, mart, state = tables
    mart.follow(base, state, spark.createDataFrame(DELIVERIES[0], PLACE), "d0")
    second = spark.createDataFrame([*DELIVERIES[1], place(None, None, 1.0, 1)], PLACE).withColumn(
        "address", F.when(F.col("address") != "aNone", F.col("address"))
    )
    for step in ("_write", "merge"):
        with monkeypatch.context() as m:
            failing = base if step == "_write" else state
            m.setattr(failing, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                mart.follow(base, state, second, "d1")
    for _ in range(2):
        mart.follow(base, state, second, "d1")
        assert summary(mart.read(state)) == summary(marts.place_summary(base.read()))


def test_groups_that_are_not_touched_are_not_written(spark, tmp_path, tables):
    base, mart, _ = tables
    state = mart.state(spark, str(tmp_path / "parted"), F.col("zip"))
    mart.follow(base, state, spark.createDataFrame(DELIVERIES[0], PLACE), "d0")
    assert mart.follow(base, state, spark.createDataFrame([place(3, 502, 2.0, 9)], PLACE), "d1") == ["502"]


def test_a_delivery_that_comes_again_writes_no_state(spark, tables):
    base, mart, state = tables
    for n in (0, 1):
        mart.follow(base, state, spark.createDataFrame(DELIVERIES[n], PLACE), f"d{n}")
    written = state.read().inputFiles()
    assert mart.follow(base, state, spark.createDataFrame(DELIVERIES[1], PLACE), "d1") == []
    assert state.read().inputFiles() == written
    assert summary(mart.read(state)) == summary(marts.place_summary(base.read()))


def test_a_first_delivery_is_not_joined(spark, tables):
    base, _, _ = tables
    source = spark.createDataFrame(DELIVERIES[0], PLACE)
    base.ensure(source.schema)
    plan = plan_of(changes(base.read(), source, base.keys))
    assert "Join" not in plan and "Exchange" not in plan


def test_both_joins_of_a_state_read_sums(spark, tables, monkeypatch):
    base, mart, state = tables
    seen, advanced = [], upkeep.advanced
    monkeypatch.setattr(upkeep, "advanced", lambda state, delta, *a: seen.append(plan_of(delta)) or advanced(state, delta, *a))
    mart.follow(base, state, spark.createDataFrame(DELIVERIES[0], PLACE), "d0")
    assert len(seen) == 1 and "Aggregate" not in seen[0]
