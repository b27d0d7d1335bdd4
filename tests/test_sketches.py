"""Sketches united over deliveries against exact counts and ranks."""

import os

import pytest
from pyspark.sql import functions as F

from areafacts.operators import sketches
from workload import frames
from workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_united_sketches_are_close_to_exact_figures(spark, tmp_path):
    """Three overlapping deliveries of 90,000 rows; the second comes twice."""
    path = str(tmp_path / "kept")
    data = [spark.range(n * 20_000, n * 20_000 + 30_000).selectExpr("id", "id % 5000 AS few", "IF(id % 10 > 0, id * id * 1.0, NULL) AS v", "id % 3 AS g") for n in range(3)]
    for n in (0, 1, 1, 2):
        sketches.keep(sketches.sketch(data[n], ["id", "few"], ["v"], by=["g"]), path, f"d{n}")
    kept = sketches.kept(spark, path)
    assert kept.count() == 9
    found = {r["column"]: r for r in sketches.estimates(sketches.united(kept), (0.1, 0.5, 0.99)).collect()}
    assert (found["id"]["n_rows"], found["id"]["missing"], found["v"]["missing"]) == (90_000, 0, 9_000)
    # three standard errors of 1.04 / sqrt(2^14)
    assert found["id"]["distinct"] == pytest.approx(70_000, rel=0.025) and found["few"]["distinct"] == pytest.approx(5_000, rel=0.025)
    rows = data[0].union(data[1]).union(data[2])
    for p, estimate in zip((0.1, 0.5, 0.99), found["v"]["quantiles"]):
        assert rows.where(F.col("v") <= estimate).count() / 81_000 == pytest.approx(p, abs=0.015)
    # by group, and groups united to the whole
    by_group = sketches.united(kept, by=["g"])
    assert sorted(r["g"] for r in sketches.estimates(by_group, by=["g"]).where("column = 'id'").collect()) == [0, 1, 2]
    again = {r["column"]: r for r in sketches.estimates(sketches.united(by_group.drop("g"))).collect()}
    assert again["id"]["distinct"] == pytest.approx(70_000, rel=0.025)


def test_nothing_known_and_no_rows(spark):
    df = spark.createDataFrame([(None, None)] * 2, "a string, b double")
    for rows, n in ((df, 2), (df.limit(0), 0)):
        found = sketches.estimates(sketches.sketch(rows, ["a"], ["b"])).collect()
        assert {tuple(r) for r in found} == {("a", n, n, 0, None), ("b", n, n, None, None)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_the_query(spark):
    raw = frames.raw_place(spark, SF)
    delivered = raw.union(raw.where("review_count BETWEEN 30 AND 39 OR review_count BETWEEN 60 AND 69"))
    found = {r["column"]: r for r in QUERIES["quality_sketches"](spark, SF).collect()}
    for c in ("address", "city", "categories", "postal_code"):
        assert found[c]["distinct"] == pytest.approx(raw.select(c).dropna().distinct().count(), rel=0.025)
        assert found[c]["missing"] == delivered.where(F.col(c).isNull()).count()
    total = delivered.count()
    for c in ("stars", "review_count", "latitude"):
        assert found[c]["n_rows"] == total
        for p, estimate in zip((0.25, 0.5, 0.75), map(float, found[c]["quantiles"].split(","))):
            low, high = (delivered.where(at).count() / total for at in (F.col(c) < estimate, F.col(c) <= estimate))
            assert low - 0.015 <= p <= high + 0.015
