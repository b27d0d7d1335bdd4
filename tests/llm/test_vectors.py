"""Both vector searches against brute force."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from areafacts.llm import exact_topk, rotated_codes
from areafacts.llm import vectors as V

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, score string, rank string"

CASES = [
    (0, [1.0, 0.0], "x", "x"),
    (100, [0.0, 1.0], "x", "x"),
    (100, [0.0, 1.0], "x", "x"),
    (200, None, None, None),
    (300, [], None, None),
    (400, [0.0, 0.0], None, None),
    (500, [float("nan"), 1.0], None, None),
    (600, [None, 1.0], None, None),
    (700, [float("inf"), 1.0], None, None),
    (800, [1.0, 2.0, 3.0], None, None),
    (None, [1.0, 1.0], None, None),
    (7, [1.0, 1.0], None, None),
    (7, [1.0, 1.0], None, None),
    (5, [1.0, 1.0], None, None),
    (3, [-1.0, 0.5], None, None),
]


def brute(rows, k, score, usable, largest):
    """Every query against every candidate."""
    live = [(i, tuple(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    live = [(i, v) for i, v in live if usable(v)]
    out = []
    for q in sorted({i for i, _ in live if i % 100 == 0}):
        vector = min(v for i, v in live if i == q)
        hits = [(score(vector, v), i) for i, v in live if i != q and len(v) == len(vector)]
        hits.sort(key=lambda h: (-h[0] if largest else h[0], h[1]))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(hits[:k])]
    return out


def integer_product(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b))


def got(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


@pytest.fixture(scope="module")
def random_rows():
    rng = np.random.default_rng(5)
    return [(int(i), [float(x) for x in rng.standard_normal(6).astype(np.float32)]) for i in range(0, 2000, 4)]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_exact_topk_cases(spark, k):
    df = spark.createDataFrame(CASES, SCHEMA)
    assert got(exact_topk.exact_topk(df, F.col("vec_id") % 100 == 0, k)) == brute(
        CASES, k, integer_product, lambda v: True, True
    )


def test_exact_topk_blocks_and_large_scores(spark, random_rows, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 3)
    rows = [(i, [x * 3e5 for x in v]) for i, v in random_rows]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(exact_topk.exact_topk(df, F.col("vec_id") % 100 == 0, 5)) == brute(rows, 5, integer_product, lambda v: True, True)


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0**27 + 1, 3.0]])
    assert exact_topk.scores(a, a)[0, 0] == (2**27 + 1) ** 2 + 9


@pytest.mark.parametrize("operator", [exact_topk.exact_topk, rotated_codes.nearest])
def test_empty_table(spark, operator):
    df = spark.createDataFrame([], SCHEMA)
    assert got(operator(df, F.col("vec_id") % 100 == 0, 10)) == []


def test_nearest_cases(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    found = got(rotated_codes.nearest(df, F.col("vec_id") % 100 == 0, 10))
    expected = brute(CASES, 10, math.dist, any, False)
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected], abs=1e-12)


@pytest.mark.parametrize("huge", [1e200, 1e308])
def test_huge_components_hide_nothing(spark, random_rows, huge):
    """One vector with components whose squares no double holds, as a candidate and as a query."""
    rows = [(i, v) for i, v in random_rows] + [(9000, [huge] + [0.0] * 5), (9001, [-huge, 1.0, 1.0, 0.0, 0.0, 0.0])]
    found = got(rotated_codes.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, 5))
    queries = sorted({i for i, _ in rows if i % 100 == 0})
    assert sorted({r[0] for r in found}) == queries and len(found) == 5 * len(queries)
    expected = {(q, n): (i, d) for q, n, i, d in brute(rows, 5, math.dist, any, False)}
    hits = [r for r in found if r[0] != 9000 and expected[r[0], r[1]][0] == r[2]]
    assert len(hits) >= 0.95 * 5 * (len(queries) - 1)
    assert all(r[3] == pytest.approx(huge, rel=1e-12) for r in found if r[0] == 9000 and r[2] != 9001)


LARGER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="driver tables are not here")
def test_recall_of_every_block_at_sf01(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 7)  # 20 queries, three blocks
    df = spark.read.parquet(f"{LARGER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    vectors = {i: np.array(v, float) for i, v in rows}
    found = got(rotated_codes.nearest(df, F.col("vec_id") % 100 == 0, 10))
    ids, whole = np.array(list(vectors)), np.array(list(vectors.values()))
    share = {}
    for q in sorted({r[0] for r in found}):
        distance = np.sqrt(((whole - vectors[q]) ** 2).sum(axis=1))
        order = [i for i in ids[np.lexsort((ids, distance))] if i != q][:10]
        share[q] = len(set(order) & {r[2] for r in found if r[0] == q}) / 10
    assert len(share) == 20 and min(share.values()) >= 0.8 and np.mean(list(share.values())) >= 0.95


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_recall_on_the_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = got(rotated_codes.nearest(df, F.col("vec_id") % 100 == 0, 10))
    expected = {(q, i): s for q, _, i, s in brute(rows, 10, math.dist, any, False)}
    hits = [r for r in found if (r[0], r[2]) in expected]
    assert len(hits) >= 0.95 * len(expected)
    assert all(r[3] == pytest.approx(expected[r[0], r[2]], abs=1e-12) for r in hits)


def test_bounds_hold_for_most_pairs(spark, random_rows):
    """The error bound is what decides on reranking: it has to hold, and to exclude something."""
    df = spark.createDataFrame(random_rows, "id long, vector array<double>")
    centre = rotated_codes.mean_vector(df, 6)
    codes = rotated_codes.index(df, 6, centre).toArrow().combine_chunks().to_batches()[0]
    block = V.Queries(np.array([r[0] for r in random_rows[:20]]), np.array([r[1] for r in random_rows[:20]]))
    lower, upper = rotated_codes.Bounds(block, centre, rotated_codes.CONFIDENCE).of(codes)
    exact = ((block.vectors[:, None] - V.matrix(codes.column("vector"))[None]) ** 2).sum(axis=2)
    assert ((lower <= exact) & (exact <= upper)).mean() > 0.99
    assert (lower > np.median(exact)).any()
