"""SimHash groups against brute force."""

import numpy as np
import pytest
import xxhash

from areafacts.llm import simhash
from areafacts.llm.components import components

SCHEMA = "doc_id long, text string, fp string, component string"


def brute_fingerprint(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, d):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


def expected(rows, d=2):
    fps = [brute_fingerprint(t) for _, t in rows]
    found = brute_components([i for i, _ in rows], fps, d)
    return sorted(((i, f"{fp:016x}", c) for (i, _), fp, c in zip(rows, fps, found)), key=str)


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base + " x"), (4, base.upper()), (3, None), (2, ""), (8, " \t\x0b "), (None, base), (None, "lone one")]
    rows += [(20, "two words"), (21, "Two WORDS"), (22, "tres  palabras\nSeñor"), (23, "É É É É"), (24, base * 40), (23, "É É É É")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"Wort{i % 97}ß" for i in range(3000))
    whole = simhash.fingerprint(text.encode(), 3) % 2**64
    assert whole == brute_fingerprint(text)
    monkeypatch.setattr(simhash.word_blocks, "__defaults__", (100,))
    assert simhash.fingerprint(text.encode(), 3) % 2**64 == whole


@pytest.mark.parametrize("d", [0, 1, 2, 3])
def test_links_lose_nothing(spark, d):
    rng = np.random.default_rng(d)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:  # chains and clouds of near fingerprints
        x = int(c)
        for _ in range(12):
            for bit in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    rows = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    got = {r["fp"]: r["component"] for r in simhash.classes(rows, d).collect()}
    assert [got[x] for x in signed] == brute_components(list(range(len(fps))), fps, d)


def test_references_determine_a_segment_and_bound_its_distance():
    t = simhash.DISTANCES.astype(int)
    assert len({tuple(r) for r in t}) == 256
    apart = np.abs(t[:, None] - t[None]).max(axis=2)
    bits = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None])
    assert (apart <= bits).all() and (apart[bits > 0] > 0).all()


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1200)] + [(1199, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub + [(3, 3)], "a long, b long")).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 5 for i in [7, *range(1000, 1200)]}
