import pytest
from pyspark.sql import functions as F

from areafacts.operators.dedupe import one_per_key, top_per_group
from tests.conftest import plan_of


@pytest.fixture
def copies(spark):
    return spark.createDataFrame(
        [(1, "x", 1.0), (1, "y", 3.0), (1, "z", 2.0), (2, "x", 1.0), (None, "n", 1.0), (None, "m", 2.0)],
        "k int, name string, v double",
    )


def test_one_row_per_key_with_null_keys_equal(copies, rows):
    assert rows(one_per_key(copies, ["k"]), "k") == [(None,), (1,), (2,)]
    assert rows(one_per_key(copies.drop("name"), ["k"]), "k") == [(None,), (1,), (2,)]


def test_survivor_is_a_whole_row(copies, rows):
    assert set(rows(one_per_key(copies, ["k"]))) <= set(rows(copies))


def test_chosen_survivor(copies, rows):
    assert rows(one_per_key(copies, ["k"], [F.col("v").desc()])) == [(None, "m", 2.0), (1, "y", 3.0), (2, "x", 1.0)]
    assert rows(one_per_key(copies, ["k"], ["name"])) == [(None, "m", 2.0), (1, "x", 1.0), (2, "x", 1.0)]


def test_missing_key_is_an_error(copies):
    with pytest.raises(Exception, match="nope"):
        one_per_key(copies, ["nope"]).count()


def test_map_side_cut(copies):
    """Copies are cut down before the shuffle, whichever plan is used."""
    plan = plan_of(one_per_key(copies, ["k"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert "partial_first" in plan_of(one_per_key(copies.drop("name"), ["k"]))
    assert "SortAggregate" not in plan_of(one_per_key(copies.drop("name"), ["k"]))


def test_top_per_group(copies, rows):
    assert rows(top_per_group(copies, ["k"], [F.col("v").desc()], 2, rank="r"), "k", "name", "r") == [
        (None, "m", 1),
        (None, "n", 2),
        (1, "y", 1),
        (1, "z", 2),
        (2, "x", 1),
    ]


def test_large_k_is_exact(spark, rows):
    """Ranking in slices first gives the same rows, for any number of rows and slices."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.lit(0)).alias("g"),
        F.xxhash64("id").alias("v"),
        "id",
    )
    order = [F.col("v"), F.col("id")]
    for k, slices in ((999, 16), (1500, 1), (1500, 64)):
        expected = []
        for g, group in df.toPandas().groupby("g"):
            best = group.sort_values(["v", "id"]).head(k)
            expected += [(g, i) for i in best["id"]]
        assert rows(top_per_group(df, ["g"], order, k, slices=slices), "g", "id") == sorted(
            expected, key=lambda r: [(v is not None, str(v)) for v in r]
        )


def test_hot_key(spark):
    """A third of all rows carry one key."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("v")
    )
    out = one_per_key(df, ["k"], [F.col("v").cast("long").desc()])
    assert out.count() == 40001
    assert out.where("k = -1").head()["v"] == "59997"


def test_slices_with_map_columns(spark, rows):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    best = top_per_group(df, ["g"], [F.col("id").desc()], 2000, slices=8)
    assert best.count() == 50
