"""Whitening against plain numpy and integers without limits."""

import math

import numpy as np
import pytest

from areafacts.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, x string, component string"


def brute(rows, k=4, scale=256):
    """(rows by (id, component), covariance, fit list) of vectors of one length."""
    live = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(i, [math.floor(scale * c) for c in v]) for i, v in live]
    fit = sorted({tuple(x) for _, x in ints})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    d = len(sums)
    covariance = np.array(
        [[sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit) / n**3 for b in range(d)] for a in range(d)]
    )
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for i, x in ints:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        centred = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        for c in range(min(k, d)):
            out.append((i, c + 1, n, deviation, centred @ axes[:, c] / math.sqrt(values[c]), values[c] / np.trace(covariance)))
    return out


def check(found, wanted):
    """Equal but for the sign of each component."""
    def plain(rows):
        return sorted(rows, key=lambda r: (r[1], r[0], abs(r[4])))

    found, wanted = plain(tuple(r) for r in found), plain(wanted)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert all(0 <= r[6] < 1e-9 for r in found)
    for c in {r[1] for r in wanted}:
        a = np.array([r[4] for r in found if r[1] == c])
        b = np.array([r[4] for r in wanted if r[1] == c])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    assert [r[5] for r in found] == pytest.approx([r[5] for r in wanted], rel=1e-9)


def test_the_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = queries.QUERIES["op12_whitening"](spark, SF)
    assert ", ".join(f"{c} {kind}" for c, kind in df.dtypes) == (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    check(df.collect(), brute(rows))


def test_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.normal(size=3) * [1, 5, 0.1]]) for i in range(300)]
    rows += [(7, rows[7][1])] * 40 + [(None, rows[3][1])]  # copies count once in the fit, and each has its rows
    odd = [(901, None), (902, []), (903, [None, 1.0, 2.0]), (904, [float("nan"), 1.0, 2.0]), (905, [1.0, float("inf"), 0.0])]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows + odd], SCHEMA).repartition(5)
    wanted = [tuple(-1 if c is None else c for c in r) for r in brute(rows)]
    found = [tuple(-1 if c is None else c for c in r) for r in whitening.whiten(df).collect()]
    check(found, wanted)


def test_lengths_are_apart_and_flat_vectors_have_no_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, -4.0]), (3, [0.5, 0.5]), (10, [1.0]), (11, [1.0]), (20, [1.0, 2.0, 3.0]), (21, [2.0, 4.0, 6.0])]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in whitening.whiten(df).collect())
    check([r for r in found if r[0] < 10], brute(rows[:3]))
    assert [r[:7] for r in found if r[0] in (10, 11)] == [(i, 1, 1, 0, None, None, None) for i in (10, 11)]
    line = [r for r in found if r[0] >= 20]
    assert [r[4] is None for r in line] == [False, True, True] * 2 and abs(line[0][4]) == pytest.approx(1)


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_components_stay_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 1.0]), (3, [1.0, 2.0**30]), (4, [1e300, -1e300])]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    found = {(r[0], r[1]): r for r in whitening.whiten(df).collect()}
    assert len(found) == 8 and all(r["deviation"] is None for r in found.values())
    assert found[1, 1]["explained"] == pytest.approx(1, abs=1e-7) and found[1, 1]["identity_error"] < 1e-4


@pytest.mark.parametrize("high,d,n", [(500, 9, 3000), (2**40, 4, 100), (2**62, 3, 130), (1, 2, 5)])
def test_counts_of_planes_are_exact(high, d, n):
    x = np.random.default_rng(2).integers(-high, high, (n, d))
    x[:, 0] = 7  # a dimension without a plane
    low = x.min(axis=0)
    bits = np.array([(a - b).bit_length() for a, b in zip(x.max(axis=0).tolist(), low.tolist())])
    found = whitening.Products(bits)
    for part in np.array_split(x, 3):
        found.add(whitening.planes(part, low, bits))
    plain = np.c_[x.astype(object) - low.astype(object), np.ones(n, object)]
    assert (np.triu(plain.T @ plain) == np.triu(found.total())).all()


def test_deviation_wraps_only_beyond_a_long():
    model = whitening.Fit(10**6, np.array([-(10**8), 5], object), None, None, 1.0)
    x = np.array([[500, -500], [2**50, 0]])
    small = sum((10**6 * a - s) ** 2 for a, s in zip((500, -500), (-(10**8), 5)))
    assert whitening.deviations(x, model) == [small, None]
