"""Language-model scores against a plain trie and plain word counts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areafacts.llm import lm_scoring, ppm
from areafacts.llm.common import fold

SCHEMA = "doc_id long, text string, score string, n string, keys string"


def plain(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


class PlainTrie:
    """Symbol by symbol: escape from the longest listed context to shorter ones, excluding what was seen."""

    def __init__(self, texts):
        self.counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        positions = 0
        for t in texts:
            data = [ppm.END] * ppm.ORDER + list(t) + [ppm.END]
            for i in range(ppm.ORDER, len(data)):
                positions += 1
                for k in range(ppm.ORDER + 1):
                    self.counts[k][tuple(data[i - k : i])][data[i]] += 1
        self.least = max(1, math.ceil(positions / ppm.NODES))

    def probability(self, context, symbol):
        share, excluded = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            counts = self.counts[k].get(tuple(context[len(context) - k :]), Counter())
            total = sum(counts.values())
            if not total or (k > 1 and total < self.least):
                continue
            # exclusion: the mass of excluded symbols is taken out of this context's own distribution
            p = self.distribution(k, context)
            return p[symbol] * share / (1 - sum(p[s] for s in excluded))
        return 1 / 256

    def distribution(self, k, context):
        if k < 0:
            return [1 / 256] * 256
        shorter = self.distribution(k - 1, context)
        counts = self.counts[k].get(tuple(context[len(context) - k :]), Counter())
        total, different = sum(counts.values()), len(counts)
        if not total or (k > 1 and total < self.least):
            return shorter
        escape = 0 if different == 256 else different / (total + different)
        rest = sum(p for s, p in enumerate(shorter) if s not in counts)
        return [(1 - escape) * counts[s] / total if s in counts else escape * p / rest for s, p in enumerate(shorter)]

    def score(self, t):
        data = [ppm.END] * ppm.ORDER + list(t) + [ppm.END]
        return sum(math.log10(self.probability(data[i - ppm.ORDER : i], data[i])) for i in range(ppm.ORDER, len(data)))


def expected(rows, learned):
    train = [plain(t) for i, t in rows if learned(i)]
    counts, ends = Counter(w for t in train for w in t.split()), len(train)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    trie = PlainTrie(train)
    out = []
    for i, t in rows:
        words = plain(t).split()
        c = [counts[w] for w in words] + [ends]
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in c)
        out.append((i, len(c), sum(x > 0 for x in c), n, base, trie.score(plain(t))))
    return out


def check(found, rows, learned):
    got = sorted((tuple(r) for r in found), key=str)
    wanted = sorted(expected(rows, learned), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[4] == pytest.approx(w[4], abs=1e-9) and g[5] == pytest.approx(w[5], rel=1e-5)


def held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 10 == 0


ROWS = [(i, f"The cat number {i % 7} sat on the mat, the dog {'ran' * (i % 3)} é{i}") for i in range(60)]
ROWS += [(100, None), (101, ""), (102, " \n "), (103, "THE THE the zebra ß"), (104, "a b c " * 400), (None, "nobody"), (3, ROWS[3][1]), (3, "other")]


@pytest.mark.parametrize("nodes, hot", [(1 << 14, 1 << 14), (64, 8), (1 << 14, 1)])
def test_rows(spark, monkeypatch, nodes, hot):
    monkeypatch.setattr(ppm, "NODES", nodes)
    monkeypatch.setattr(lm_scoring, "HOT", hot)
    docs = spark.createDataFrame([(i, t, "s", None, "k") for i, t in ROWS], SCHEMA).repartition(3)
    model = lm_scoring.learn(docs, fold("doc_id", 10) != 0)
    assert len(model.hot) <= hot
    check(lm_scoring.score(docs, model).collect(), ROWS, lambda i: not held_out(i))


def test_tasks_that_send_early_lose_nothing(monkeypatch):
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 40)
    monkeypatch.setattr(lm_scoring, "HELD", 60)
    rows = [plain(t) for _, t in ROWS]
    schema = pa.schema([("text", pa.string())])
    batches = [pa.RecordBatch.from_pydict({"text": [t for _, t in ROWS[i : i + 9]]}, schema) for i in range(0, len(ROWS), 9)]
    sent = [r for b in lm_scoring._gather(5)(iter(batches)) for r in b.to_pylist()]
    words, grams = Counter(), []
    for r in sent:
        if r["kind"] == lm_scoring.WORDS:
            words.update(dict(zip(r["keys"].split(b" "), np.frombuffer(r["counts"], np.int64).tolist())))
        if r["kind"] == ppm.ORDER:
            grams.append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
    assert words == Counter(w for t in rows for w in t.split())
    for got, wanted in zip(ppm.merged(grams), ppm.grams(rows)):
        assert got.tolist() == wanted.tolist()
    assert sum(r["n"] for r in sent if r["kind"] == lm_scoring.DOCUMENTS) == len(rows)
    assert len({r["bucket"] for r in sent}) == 5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "ab", "", "", ""), (2, None, "", "", "")], SCHEMA)
    check(lm_scoring.score(docs, lm_scoring.learn(docs, F.lit(False))).collect(), [(1, "ab"), (2, None)], lambda i: False)
    empty = docs.where("false")
    assert lm_scoring.score(empty, lm_scoring.learn(empty, F.lit(True))).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abé ", max_size=12), max_size=6), st.text("abcé", max_size=10))
def test_trie(texts, other):
    rows = [t.encode() for t in texts]
    key, count = ppm.merged([ppm.grams(rows[i::2]) for i in (0, 1)])
    levels = [ppm.shortened(key, count, k) for k in range(ppm.ORDER + 1)]
    trie, slow = ppm.Trie.of(levels), PlainTrie(rows)
    wanted = [slow.score(t) for t in [*rows, other.encode()]]
    assert trie.score([*rows, other.encode()]).tolist() == pytest.approx(wanted, rel=1e-5)


def test_every_distribution_sums_to_one():
    key, count = ppm.grams([b"abracadabra", b"abba", b"\xc3\xa9"])
    trie = ppm.Trie.of([ppm.shortened(key, count, k) for k in range(ppm.ORDER + 1)])
    assert (10.0 ** trie.logp.reshape(-1, 256)).sum(axis=1) == pytest.approx(1, abs=1e-4)


def test_better_than_words_on_new_text(spark):
    """A model of a language scores its texts far above shuffled bytes."""
    rows = [(i, "the quick brown fox jumps over the lazy dog " * 5) for i in range(30)] + [(1000, "xq zk vj " * 24), (1001, "the lazy fox jumps " * 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["score"] / len(t) for r, (_, t) in zip(lm_scoring.score(docs, lm_scoring.learn(docs, F.col("doc_id") < 30)).orderBy("doc_id").collect(), rows)}
    assert found[1001] > found[1000] + 0.5


def test_rare_contexts_count(spark):
    """More positions than contexts are broadcast: contexts met once have their place in the score."""
    rows = [(i, " ".join(f"{zlib.crc32(b'%d %d' % (i, j)) % 5000:x}" for j in range(60))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = lm_scoring.learn(docs, F.col("doc_id") < 98)
    trie = PlainTrie([plain(t) for i, t in rows if i < 98])
    assert sum(trie.counts[0][()].values()) > lm_scoring.SHARED
    trie.least = 1
    found = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs.where("doc_id > 95"), model).collect()}
    assert found == {i: pytest.approx(trie.score(plain(t)), rel=1e-5) for i, t in rows[96:]}
