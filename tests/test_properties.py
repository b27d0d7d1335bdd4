"""Properties of the operators on generated data."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areafacts.functions import normalize as N
from areafacts.functions.measures import latest
from areafacts.operators.dedupe import one_per_key
from areafacts.operators.reshape import wide_to_long

texts = st.text(alphabet=" abcCOUNTYcounty,-", max_size=14)
few = settings(max_examples=10, deadline=None)


@few
@given(st.lists(texts, min_size=1, max_size=20))
def test_label_is_idempotent_and_county_is_a_label(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select("x", N.label("x").alias("l"), N.county("x").alias("c"))
    for r in once.select("*", N.label("l").alias("l2"), N.label("c").alias("c2")).collect():
        assert r["l"] == r["l2"] == r["x"].strip(" ").lower()
        plain = r["x"][: -len(" county")] if r["x"].lower().endswith(" county") else r["x"]
        assert r["c"] == r["c2"] == plain.strip(" ").lower()


@few
@given(
    st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.floats(-9, 9))), min_size=1, max_size=12),
    st.integers(1, 4),
)
def test_unpivot_makes_rows_times_columns(spark, data, months):
    names = [f"20{m:02d}-01-31" for m in range(months)]
    df = spark.createDataFrame([(k, *[v] * months) for k, v in data], _ddl(names))
    out = wide_to_long(df).collect()
    assert len(out) == len(data) * months
    assert sorted(str((r["id"], r["Value"])) for r in out) == sorted(str(t) for t in data for _ in names)


def _ddl(names):
    return "id int, " + ", ".join(f"`{n}` double" for n in names)


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 99)), min_size=1, max_size=30))
def test_dedupe_keeps_the_best_of_each_key(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    best = {}
    for k, v in data:
        best[k] = max(v, best.get(k, v))
    out = one_per_key(df.repartition(3), ["k"], [F.col("v").desc()])
    assert {r["k"]: r["v"] for r in out.collect()} == best
    assert {r["k"] for r in one_per_key(df, ["k"]).collect()} == set(best)


days = st.one_of(st.none(), st.dates())


@few
@given(st.lists(st.tuples(days, days), min_size=1, max_size=12, unique=True))
def test_latest_orders_like_the_dates(spark, data):
    rows = [(i, a, b) for i, (a, b) in enumerate(data)]
    df = spark.createDataFrame(rows, "i int, a date, b date")
    got = df.agg(latest(F.col("i"), F.col("a"), F.col("b"))).head()[0]
    first = lambda d: (d is not None, d) if d is not None else (False,)
    assert got == max(rows, key=lambda r: (first(r[1]), first(r[2])))[0]
