"""The field against enumeration, document scores on held-out labels, odd rows."""

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from areafacts.llm import crf, queries, toxicity

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, predicted string, toxic string"


def enumerated(scores, pairs):
    """Marginals by summing over every labelling."""
    total, ones = 0.0, np.zeros(len(scores))
    for y in itertools.product((0, 1), repeat=len(scores)):
        weight = np.exp(sum(s for s, l in zip(scores, y) if l) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
        total += weight
        ones += weight * np.array(y)
    return ones / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    pairs = rng.normal(size=(2, 2))
    lengths = [1, 4, 7, 7, 2]
    scores, live = np.zeros((7, 5)), np.zeros((7, 5), bool)
    for i, n in enumerate(lengths):
        scores[:n, i], live[:n, i] = rng.normal(size=n) * 3, True
    p = crf.marginals(scores, live, pairs)
    for i, n in enumerate(lengths):
        assert p[:n, i] == pytest.approx(enumerated(scores[:n, i], pairs))
        assert (p[n:, i] == 0).all()


def test_training_climbs_the_likelihood():
    """After training, expected and observed counts agree, as they do where the likelihood is largest."""
    rng = np.random.default_rng(2)
    features = rng.integers(0, 6, (8, 40, 2))
    labels = ((features == 3).any(axis=2) & (rng.random((8, 40)) < 0.9)).astype(int)
    live = np.ones((8, 40), bool)
    live[5:, :10] = False
    labels[~live] = 0
    field = crf.train(features, live, labels, 6, 800, 0.05, 0.0)
    p = crf.marginals(field.weights[features].sum(axis=2) * live, live, field.pairs)
    for f in range(6):
        n = (features == f).sum(axis=2)
        assert (p * n).sum() == pytest.approx((labels * n).sum(), abs=0.5)


def test_chains_see_neighbours_across_documents_never(monkeypatch):
    model = toxicity.Model(0.1, {b"bad": 5.0}, crf.Field(np.random.default_rng(0).normal(size=toxicity.WEIGHTS), np.zeros((2, 2))))
    docs = [[b"a", b"bad", b"b"], [], [b"c"], [b"x"] * 130]
    together = toxicity.tag(model.words(), docs)
    assert [len(p) for p in together] == [3, 0, 1, 130]
    for doc, p in zip(docs, together):
        assert p == pytest.approx(toxicity.tag(model.words(), [doc])[0])


def test_offsets_are_code_points():
    text = "Élan, BAD-bad word; ß bad."
    flagged = np.array([t in (b"bad",) for t in toxicity.tokens(text.encode())])
    spans = toxicity._offsets(text.encode(), flagged).split(",")
    assert [text[int(a) : int(b)] for a, b in (s.split(":") for s in spans)] == ["BAD-bad", "bad"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    found = queries.QUERIES["op7_toxicity"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    judged = found.where("held_out").join(labels, "doc_id").toPandas()
    hit = (judged.predicted == judged.toxic)
    assert hit[judged.toxic == 1].mean() > 0.85 and hit[judged.toxic == 0].mean() > 0.97


def test_odd_rows(spark):
    rows = [(i, f"you are a scum and moron number {i}" if i % 3 == 0 else f"lovely words for everyone {i}", "", "", "") for i in range(90)]
    odd = [(200, None, "", "", ""), (201, "", "", "", ""), (202, "lovely words " * 40_000 + "scum moron", "", "", ""), (None, "scum", None, None, None)]
    odd += [(203, "Scum!", "", "", ""), (203, "Scum!", "", "", "")]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    labels = [(i, 1 if i % 3 == 0 else 0, "x") for i in range(90)] + [(5, None, "x"), (None, 1, "x"), (6, 0, "x"), (999, 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = toxicity.learn(docs, labels, F.lit(True))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 90:
            assert r["predicted"] == int(r["doc_id"] % 3 == 0)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[200]["score"] == by_id[201]["score"] < 0.5
    assert by_id[202]["toxic_spans"].startswith("520000:")
    assert by_id[203]["predicted"] == 1 and by_id[203]["toxic_spans"] == "0:4"


def test_one_label_only(spark):
    docs = spark.createDataFrame([(1, "a", "", "", ""), (2, None, "", "", "")], SCHEMA)
    for given, expected in (([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0)):
        labels = spark.createDataFrame(given, "doc_id long, toxic int")
        found = toxicity.score(docs, toxicity.learn(docs, labels, F.lit(True))).collect()
        assert [(r["score"], r["predicted"]) for r in found] == [(expected, int(expected))] * 2
    assert toxicity.score(docs.where("false"), toxicity.Model(0.0)).collect() == []


@pytest.mark.parametrize("listed", [toxicity.LISTED, 20])
def test_many_rare_insults(spark, monkeypatch, listed):
    """Sixty insults without a common beginning, each in less than 2% of the toxic documents; those held out have no other."""
    monkeypatch.setattr(toxicity, "LISTED", listed)
    insults = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(120 - i % 23)}{i}ard" for i in range(60)]
    rows = [(i, f"some plain words about number {i % 7} and {insults[i % 60]} here") for i in range(900)]
    rows += [(1000 + i, f"some plain words about number {i % 7} and town{i % 40} here") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, toxic int")
    assert 15 / 900 < toxicity.SUPPORT
    model = toxicity.learn(docs, labels, F.col("doc_id") % 1000 >= 60)
    assert (model.rare is None) == (listed == toxicity.LISTED and listed > 20)
    found = {r["doc_id"]: r for r in toxicity.score(docs.where("doc_id < 60 or doc_id >= 6900"), model).collect()}
    for i, text in rows[:60]:
        start = text.index(insults[i])
        assert found[i]["predicted"] == 1 and found[i]["toxic_spans"] == f"{start}:{start + len(insults[i])}"
    assert not any(r["predicted"] for i, r in found.items() if i >= 1000)
