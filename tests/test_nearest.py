"""Blocked edit distance against all pairs."""

import random

import pytest

from areafacts.operators.nearest import nearest_labels


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def brute(labels, known, most):
    out = set()
    for state, text in set(labels):
        near = [(distance(text, k), k) for s, k in set(known) if text is not None and k is not None and s is not None and s == state]
        best = min((n for n in near if n[0] <= most), default=(None, None))
        out.add((state, text, best[1], best[0]))
    return out


def found(spark, labels, known, most):
    schema = "state string, county string"
    df = nearest_labels(spark.createDataFrame(labels, schema), spark.createDataFrame(known, schema), "county", ["state"], most)
    assert df.columns == ["state", "county", "proposal", "distance"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_no_pair_is_lost(spark, most):
    rng = random.Random(most)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 9))) for _ in range(150)]
    labels = [(rng.choice("xy"), t) for t in texts[:100]]
    known = [(rng.choice("xy"), t) for t in texts[60:]]
    assert found(spark, labels, known, most) == brute(labels, known, most)


def test_nulls_copies_and_letters_beyond_ascii(spark):
    labels = [("wa", "kíng"), ("wa", "kíng"), (None, "king"), ("wa", None), ("or", "king"), ("wa", "kingdom")]
    known = [("wa", "king"), ("wa", "king"), ("wa", None), (None, "king"), ("wa", "kin")]
    assert found(spark, labels, known, 2) == brute(labels, known, 2)
    assert found(spark, labels, known[:0] + [("zz", "q")], 2) == {(s, t, None, None) for s, t in set(labels)}


def test_of_equally_close_ones_the_first(spark):
    assert found(spark, [("wa", "bat")], [("wa", "cat"), ("wa", "bar"), ("wa", "rat")], 2) == {("wa", "bat", "bar", 1)}


def test_no_all_pairs(spark):
    """What meets is bounded by shared segments: 2,000 unlike labels a side, few of which share one."""
    from tests.conftest import plan_of

    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(15)) for _ in range(2000)]
    df = spark.createDataFrame([("wa", t) for t in texts], "state string, county string")
    result = nearest_labels(df, df, "county", ["state"], 2)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert result.where("distance = 0").count() == 2000
