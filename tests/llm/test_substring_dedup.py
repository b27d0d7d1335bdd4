"""Repeated passages against brute force, and transforms and their merge against sorting."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from areafacts.llm import bwt, queries, substring_dedup
from tests.conftest import plan_of
from tools.compare import duck

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, spans string, id string"


def brute(rows, length):
    """Every window of every text in a dictionary of earliest documents."""
    none = 2**63 - 1
    first = {}
    data = [(none if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, none), i)
    out = []
    for (i, t), (doc_id, _) in zip(data, rows):
        covered = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                covered[p : p + length] = b"\1" * length
        spans, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and covered[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = max(end, at + 1)
        out.append((doc_id, len(t), spans, bytes(b for b, c in zip(t, covered) if not c)))
    return out


def got(df):
    return sorted([(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()], key=str)


def rotations(strings, depth):
    return [((s + b"\0\0") * (depth + 1))[i : i + depth] for s in strings for i in range(len(s) + 2)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=20).map(str.encode), min_size=1, max_size=6), min_size=1, max_size=5))
def test_merged_transforms_are_in_order(collections):
    depth = 12
    parts = [bwt.transform(np.frombuffer(b"".join(s), np.uint8), np.array([len(x) for x in s]), depth) for s in collections]
    rows = [rotations(s, depth) for s in collections]
    for part, all_ in zip(parts, rows):
        assert [all_[i] for i in part.at] == sorted(all_)
    source, rotation, interval = bwt.merge(parts, depth)
    found = [rows[a][b] for a, b in zip(source, rotation)]
    assert found == sorted(found) and len(found) == sum(map(len, rows))
    assert [a == b for a, b in zip(found, found[1:])] == (interval[1:] == interval[:-1]).tolist()


def test_rolling_hashes_and_minima():
    data = np.frombuffer(b"abracadabra abracadabra" * 4, np.uint8)
    for n in (1, 2, 7, 16, 50):
        hashes, seen = substring_dedup.rolling(data, n), {}
        assert len(hashes) == len(data) - n + 1
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(h, bytes(data[i : i + n])) == bytes(data[i : i + n])
        assert len(seen) == len({bytes(data[i : i + n]) for i in range(len(data) - n + 1)})
    x = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for w in range(1, 8):
        assert substring_dedup.sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]


def test_blocks_do_not_show(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abcd ") for _ in range(rng.choice([0, 3, 19, 20, 21, 150, 700]))) for _ in range(40)] + [b"z" * 300]
    sizes = np.array([len(t) for t in texts], np.int64)
    row = {"text": zstandard.compress(b"".join(texts)), "n_bytes": int(sizes.sum()), "sizes": sizes.tobytes(), "ids": np.arange(len(texts)).tobytes()}
    whole = substring_dedup.Shard(row).anchored(20)
    assert whole[1].sum() == sum(max(0, len(t) - 19) for t in texts)
    for block in (1, 7, 64, 333):
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        for a, b in zip(whole, substring_dedup.Shard(row).anchored(20)):
            assert a.tolist() == b.tolist()


def test_anchors_spread_over_the_buckets():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 123, 200_000).astype(np.uint8).tobytes()
    row = {"text": zstandard.compress(text), "n_bytes": len(text), "sizes": np.array([len(text)]).tobytes(), "ids": np.array([1]).tobytes()}
    hashes = substring_dedup.Shard(row).anchored(50)[2]
    share = np.bincount(substring_dedup._bucket(np.unique(hashes), 16), minlength=16) / len(np.unique(hashes))
    assert share.max() < 0.08 and share.min() > 0.045


def fixture(seed):
    rng = random.Random(seed)
    words = ["ab", "é", "the", "of", "ß\n", "x y", "aaaa", "\0"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 5))]
        text = " ".join(parts)
        if rng.random() < 0.3 and rows:
            text = rows[-1][1] if rng.random() < 0.5 else (rows[-1][1] or "").replace("the", "teh", 2)
        rows.append((rng.randint(0, 80), text))
    rows += [(500, None), (501, ""), (None, passages[0] + " tail"), (None, passages[0]), rows[3], rows[3], (7, "a" * 300), (8, "a" * 200 + "b")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, length, shard_bytes, hot", [(1, 20, 400, 10**9), (2, 20, 10**6, 3), (3, 50, 700, 4), (4, 18, 300, 1), (5, 50, 10**6, 10**9)])
def test_rows(spark, monkeypatch, seed, length, shard_bytes, hot):
    rows = fixture(seed)
    docs = spark.createDataFrame([(i, t, "k", "s", "x") for i, t in rows], SCHEMA).repartition(3)
    found = got(substring_dedup.dedup(docs, length, shard_bytes=shard_bytes, hot=hot))
    assert found == sorted(brute(rows, length), key=str)


def test_shuffled_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BROADCAST", 0)
    rows = fixture(6)
    docs = spark.createDataFrame([(i, t, "k", "s", "x") for i, t in rows], SCHEMA)
    assert got(substring_dedup.dedup(docs, 20, shard_bytes=500)) == sorted(brute(rows, 20), key=str)


def test_texts_are_not_shuffled_to_their_answers(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(substring_dedup, "BROADCAST", 0)
    joined = substring_dedup._with_answers
    monkeypatch.setattr(substring_dedup, "_with_answers", lambda *a: plans.append(joined(*a)) or plans[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(i, t, "k", "s", "x") for i, t in fixture(7)], SCHEMA).repartition(3)
        substring_dedup.dedup(docs, 20, shard_bytes=500)
        assert len(plans) == 2
        assert all("SortMergeJoin" in plan_of(p) and "Exchange" not in plan_of(p) for p in plans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_messages_are_small_and_come_back():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 2**64, 50_000, dtype=np.uint64))
    data = substring_dedup.short(hashes)
    assert substring_dedup.lengthened(data).tolist() == (hashes >> np.uint64(16) << np.uint64(16)).tolist()
    assert len(pa.compress(data, codec="lz4_raw", asbytes=True)) < 0.8 * 6 * len(hashes)
    contexts = [f"context {i % 40} of some length".encode() for i in range(500)]
    sizes, least = np.array([len(c) for c in contexts], np.int64), rng.integers(0, 2**62, 500)
    least[3] = substring_dedup.NO_ID
    pressed = substring_dedup.pressed(sizes, least, contexts, zstandard.ZstdCompressor(level=3))
    got_sizes, got_least, text = substring_dedup.expanded(pressed, 500, zstandard.ZstdDecompressor())
    assert got_sizes.tolist() == sizes.tolist() and got_least.tolist() == least.tolist() and text == b"".join(contexts)
    assert len(pressed) < 0.5 * sum(sizes + 12)


def sent_contexts(seed, senders):
    """Rows as shards send them, and per row (contexts, own earliest documents): contexts over two letters an anchor."""
    rng = random.Random(seed)
    press, rows, sent = zstandard.ZstdCompressor(), [], []
    for shard in range(senders):
        mine = {}
        for _ in range(rng.randint(1, 5)):
            k = rng.randrange(6)
            size = rng.randint(8, 22)
            c = bytes(rng.choice([97 + 2 * k, 98 + 2 * k]) for _ in range(size)) if k else b"m" * size
            mine[k, c] = rng.choice([substring_dedup.NO_ID, rng.randrange(10**6)])
        contexts = sorted(mine)
        anchors = np.array([k << 20 for k, _ in contexts], np.uint64)
        sizes, least = np.array([len(c) for _, c in contexts], np.int64), np.array([mine[c] for c in contexts], np.int64)
        rows.append({"b0": substring_dedup.short(anchors), "b1": substring_dedup.pressed(sizes, least, [c for _, c in contexts], press)})
        sent.append(([c for _, c in contexts], least.tolist()))
    return rows, sent


@pytest.mark.parametrize("merged", [1, 90, 700, 250_000])
def test_windows_are_compared_across_all_senders(monkeypatch, merged):
    monkeypatch.setattr(substring_dedup, "MERGED", merged)
    for seed, senders in [(1, 1), (2, 2), (3, 30), (4, 300)]:
        rows, sent = sent_contexts(seed, senders)
        first = {}
        for contexts, least in sent:
            for c, i in zip(contexts, least):
                for p in range(len(c) - 7):
                    first[c[p : p + 8]] = min(first.get(c[p : p + 8], i), i)
        wanted = [[first[c[p : p + 8]] < i for c, i in zip(*row) for p in range(len(c) - 7)] for row in sent]
        assert [bits.tolist() for bits in substring_dedup._compare_contexts(rows, 8)] == wanted


def test_windows_of_one_hash_are_still_told_apart(monkeypatch):
    rolling = substring_dedup.rolling
    monkeypatch.setattr(substring_dedup, "rolling", lambda *a: rolling(*a) & np.uint64(3))
    rows, sent = sent_contexts(5, 80)
    found = substring_dedup._compare_contexts(rows, 8)
    monkeypatch.undo()
    assert [a.tolist() for a in found] == [a.tolist() for a in substring_dedup._compare_contexts(rows, 8)]


def test_transforms_do_not_grow_with_the_senders(monkeypatch):
    sizes, transform = [], bwt.transform
    monkeypatch.setattr(bwt, "transform", lambda text, *a: sizes.append(len(text)) or transform(text, *a))
    for senders in (300, 1200):
        sizes.clear()
        rows, _ = sent_contexts(6, senders)
        substring_dedup._compare_contexts(rows, 8)
        assert 1 < len(sizes) <= 8


def test_windows_without_an_equal_are_not_merged(monkeypatch):
    sizes, transform = [], bwt.transform
    monkeypatch.setattr(bwt, "transform", lambda text, *a: sizes.append(len(text)) or transform(text, *a))
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n)).encode()
    middle, twice = letters(24), letters(70)
    press, rows = zstandard.ZstdCompressor(), []
    for shard in range(40):
        contexts = [letters(25) + middle + letters(25)] + [twice] * (shard in (7, 30))
        rows.append(
            {
                "b0": substring_dedup.short(np.full(len(contexts), 1 << 30, np.uint64)),
                "b1": substring_dedup.pressed(np.array([len(c) for c in contexts], np.int64), np.full(len(contexts), shard), contexts, press),
            }
        )
    found = [bits.sum() for bits in substring_dedup._compare_contexts(rows, 50)]
    assert found == [21 * (shard == 30) for shard in range(40)]
    assert sum(sizes) == 0  # twice is one context, the others have no window in common


def test_messages_fall_with_larger_shards():
    """Shards times buckets of 10 GB of text: 6.2 million with shards of 2 MB."""
    shards = 10 * 10**9 // substring_dedup.SHARD
    assert shards * shards // substring_dedup.SHARDS_A_BUCKET <= 1.6 * 10**6


def test_batches_of_messages_are_bounded():
    messages = [substring_dedup._message(1, i, 0, b"x" * 100_000) for i in range(50)] + [substring_dedup._message(1, 50, 0)] * 600
    found = list(substring_dedup._sent(iter(messages), most_bytes=1_000_000))
    assert [r["bucket"] for b in found for r in b.to_pylist()] == [m[1] for m in messages]
    assert max(b.nbytes for b in found) < 1_200_000 and max(b.num_rows for b in found) == 256


def test_long_text_and_small_merges(spark, monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    rows = [(1, base), (2, base[1000:30_000] + "!" + base[30_000:50_000]), (3, "?" + base[45_000:45_050]), (4, base[45_000:45_049])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substring_dedup.dedup(docs, 50, shard_bytes=10_000)) == sorted(brute(rows, 50), key=str)


def test_empty_table(spark):
    assert substring_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op8_substring_dedup"](spark, SF).collect()}
    wanted = brute(rows, 50)
    assert len(found) == len(wanted)
    for doc_id, n, spans, kept in wanted:
        assert found[doc_id] == (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())


# Bytes are pairs of hexadecimal digits here: SQL cuts text, not bytes. Minutes on larger tables, so it is no oracle.
SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), places AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS byte, CASE WHEN p + 50 <= n THEN substr(h, 2 * p + 1, 100) END AS w
  FROM (SELECT doc_id, h, n, unnest(range(n)) AS p FROM d)
), firsts AS (
  SELECT w, MIN(doc_id) AS first FROM places WHERE w IS NOT NULL GROUP BY w HAVING MIN(doc_id) < MAX(doc_id)
), removed AS (
  SELECT DISTINCT doc_id, p FROM places JOIN firsts USING (w) WHERE first < doc_id
), bytes AS (
  SELECT places.doc_id, places.p, byte,
         MAX(removed.p) OVER (PARTITION BY places.doc_id ORDER BY places.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)
           IS NOT NULL AS gone
  FROM places LEFT JOIN removed ON removed.doc_id = places.doc_id AND removed.p = places.p
), marked AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), FALSE) AS starts FROM bytes
), summed AS (
  SELECT doc_id, COUNT(*) FILTER (gone) AS n_removed, COUNT(*) FILTER (starts) AS n_spans,
         string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN summed ON summed.doc_id = d.doc_id
"""


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")
def test_query_against_sql(spark):
    wanted = duck(SMALL).sql(SQL).fetchall()
    found = [tuple(r) for r in queries.QUERIES["op8_substring_dedup"](spark, SMALL).collect()]
    assert sorted(found) == sorted(wanted)
