from pyspark.sql import functions as F

from areafacts.functions import rules as R
from areafacts.operators import quality


def frame(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), (None, 6.0), ("b", None), (None, None)], "name string, stars double"
    )


def rules():
    return {"name": R.present("name"), "stars": R.in_range("stars", 1, 5)}


def test_rules_split_the_rows(spark, rows):
    kept, rejected = quality.apply_rules(frame(spark), rules())
    assert rows(kept) == [("a", 1.0), ("a", 1.0)]
    assert rejected.columns == ["name", "stars", "reasons"]
    assert sorted(r["reasons"] for r in rejected.collect()) == [["name", "stars"], ["name", "stars"], ["stars"]]
    assert kept.count() + rejected.count() == 5


def test_require(spark, rows):
    assert rows(quality.require(frame(spark), ["name", "stars"])) == [("a", 1.0), ("a", 1.0)]


def test_report(spark):
    out = quality.report(frame(spark), ["name", "stars"], rules())
    assert {r["check"]: (r["total"], r["failures"]) for r in out.collect()} == {
        "null:name": (5, 2),
        "null:stars": (5, 2),
        "rule:name": (5, 2),
        "rule:stars": (5, 3),
        "duplicate:name,stars": (5, 1),
    }


def test_report_of_nothing(spark):
    out = quality.report(frame(spark).limit(0), ["name"])
    assert {r["check"]: (r["total"], r["failures"]) for r in out.collect()} == {
        "null:name": (0, 0),
        "null:stars": (0, 0),
        "duplicate:name": (0, 0),
    }


def test_orphans(spark, rows):
    left = spark.createDataFrame([("king", "wa"), ("king", "wa"), ("king", "tx"), (None, "wa")], "c string, s string")
    right = spark.createDataFrame([("king", "wa"), ("pierce", "wa"), (None, "wa")], "c string, s string")
    assert rows(quality.orphans(left, right, ["c", "s"])) == [
        (None, "wa", "left"),
        (None, "wa", "right"),
        ("king", "tx", "left"),
        ("pierce", "wa", "right"),
    ]


def test_digit_rule(spark):
    texts = ["00501", "10001\n", "10001-1234", "", "12a", "٣٤", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r["x"] for r in df.where(R.matches("x", R.DIGITS)).collect()] == ["00501", "10001\n"]


def test_region_type(spark):
    df = spark.createDataFrame([(5,), (6,), (None,)], "region_type_id int")
    assert quality.keep_region_type(df).count() == 1
    assert quality.keep_region_type(df, 6).count() == 1


def test_unknown_is_not_true(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(R.holds(F.col("x") > 1)).head()[0] is False


def test_conform(spark, rows):
    df = spark.createDataFrame([("7", 8, 1.5, "x", "2023-01-31")], "a string, B long, c double, d string, e string")
    schema = "a int, b int, c int, e date, missing string"
    wanted = spark.createDataFrame([], schema).schema
    out = quality.conform(df, wanted)
    assert out.dtypes == [("a", "int"), ("B", "int"), ("c", "double"), ("d", "string"), ("e", "date")]
    assert out.head()["a"] == 7
    same = spark.createDataFrame([(1,)], "a int")
    assert quality.conform(same, wanted) is same
