"""Language identification: gradients, a plain network, held-out accuracy, odd rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from areafacts.llm import gru, language_id, queries
from areafacts.llm.common import fold

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = gru.Network.random(3, 2, 1)
    net.parameters = {k: v.astype(float) for k, v in net.parameters.items()}
    window, live = gru.padded([b"abcde", b"bca", b"e"])
    label = np.array([0, 1, 1])
    _, grads = gru.gradients(net, window, live, label)
    for name, value in net.parameters.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if name[0] == "X":
                at = (int(rng.choice(list(b"abcde"))), at[1])
            step, losses = 1e-2, []
            for sign in (1, -1):
                value[at] += sign * step
                losses.append(gru.gradients(net, window, live, label)[0])
                value[at] -= sign * step
            assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / (2 * step), abs=2e-4)


def plain_probabilities(net, data):
    """Position by position, one window at a time."""
    p, h = net.parameters, net.hidden

    def states(X, U, window):
        state, out = np.zeros(h), []
        for byte in window:
            x, a = X[byte], state @ U
            z, r = (1 / (1 + np.exp(-(x[i * h : i * h + h] + a[i * h : i * h + h]))) for i in (0, 1))
            n = np.tanh(x[2 * h :] + r * a[2 * h :])
            state = (1 - z) * n + z * state
            out.append(state)
        return out

    for start in range(0, len(data), language_id.WINDOW):
        window = data[start : start + language_id.WINDOW]
        forth, back = states(p["Xf"], p["Uf"], window), states(p["Xb"], p["Ub"], window[::-1])[::-1]
        for f, b in zip(forth, back):
            e = np.exp(np.concatenate([f, b]) @ p["W"] + p["bias"])
            yield e / e.sum()


def test_whole_texts_are_pooled(monkeypatch):
    monkeypatch.setattr(language_id, "LANES", 3)
    net = gru.Network.random(5, 3, 2)
    rows = [b"", b"a", b"x" * 64, bytes(range(256)) * 3, b"caf\xc3\xa9 " * 40, b"z" * 65]
    total, carried = language_id.pooled(net, rows)
    for row, t, c in zip(rows, total, carried):
        assert t == pytest.approx(sum(plain_probabilities(net, row), np.zeros(3)), abs=1e-3)
        assert c.sum() == len(row)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op1_language_id"](spark, SF).join(truth, "doc_id").where("held_out").toPandas()
    assert len(found) > 200
    assert (found.lang_pred == found.lang).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_odd_rows(spark):
    english, german = "the thing and other things that were here", "der die das und nicht wirklich schön ist"
    rows = [(i, (english if i % 2 else german) + f" {i}", "en" if i % 2 else "de", None, None) for i in range(60)]
    odd = [(100, None, "en", "", ""), (101, "", None, "", ""), (102, "12 34 !? \U0001f600", "de", "", ""), (None, english, None, "", "")]
    odd += [(103, english * 5000, None, None, None), (104, "ß", None, None, None), (104, "ß", None, None, None)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    model = language_id.learn(docs, fold("doc_id", 3) != 1, rounds=60)
    found = language_id.label(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (100, 101, 102))
    assert by_id[103]["lang_pred"] == by_id[None]["lang_pred"] == "en"
    assert by_id[103]["n_positions"] == len(english * 5000)
    assert by_id[104]["lang_pred"] in ("de", "en")
    again = language_id.label(docs, language_id.learn(docs.repartition(7), fold("doc_id", 3) != 1, rounds=60)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


@pytest.mark.parametrize("languages", [[], ["en"]])
def test_too_few_languages(spark, languages):
    docs = spark.createDataFrame([(1, "some text", (languages or [None])[0], "", ""), (2, "1", None, "", "")], SCHEMA)
    model = language_id.learn(docs, F.lit(True))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.label(docs, model).collect()}
    assert found == {1: (languages[0], 1.0) if languages else ("und", 0.0), 2: ("und", 0.0)}
    empty = docs.where("false")
    assert language_id.label(empty, language_id.learn(empty, F.lit(True))).collect() == []


def test_copies_take_one_place_of_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(f"{name} text number {i}", name) for name in ("de", "en") for i in range(40)], "text string, lang string")
    first = [r["t"] for r in docs.groupBy("lang").agg(F.min_by("text", F.xxhash64(F.lit(language_id.SEED), "text")).alias("t")).collect()]
    copies = spark.createDataFrame([(t, t[:2]) for t in first] * 200, "text string, lang string")
    trained = []
    monkeypatch.setattr(gru, "train", lambda windows, labels, *options: trained.append((windows, labels)))
    language_id.learn(docs.unionByName(copies), F.lit(True), sample=20)
    [(windows, labels)] = trained
    assert [len(labels[labels == k]) for k in (0, 1)] == [20, 20]
    assert all(len({w for w, k in zip(windows, labels) if k == label}) > 8 for label in (0, 1))
