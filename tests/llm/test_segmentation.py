"""Sampled segmentations against enumeration of a small lattice, and exact round trips."""

import itertools
import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from areafacts.llm import segmentation
from areafacts.llm.lattice import SPACE, Known, Lattice, Vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, pieces string, sample string"

PIECES = ["<b>"] * 256 + [SPACE, "a", "b", "ab", SPACE + "a", SPACE + "ab", "ba", "aba", SPACE + SPACE]


def small():
    rng = np.random.default_rng(4)
    logp = np.concatenate([np.full(256, -6.0), -rng.uniform(0.5, 4, len(PIECES) - 256)])
    return Vocabulary.of({p: i for i, p in enumerate(PIECES) if i >= 256}, logp, PIECES, np.arange(256))


def enumerated(text, v):
    """All segmentations of the whole text with their probabilities; no units."""
    whole = SPACE + text.replace(" ", SPACE)
    pieces = {p: i for i, p in enumerate(PIECES) if i >= 256}

    def ways(rest):
        if not rest:
            yield (), 0.0
            return
        found = [(p, (i,), v.logp[i]) for p, i in pieces.items() if rest.startswith(p)]
        if rest[0] not in pieces:
            found.append((rest[0], tuple(rest[0].encode()), -6.0 * len(rest[0].encode())))
        for p, ids, w in found:
            for tail, wt in ways(rest[len(p) :]):
                yield ids + tail, w + wt

    weight = {ids: math.exp(w) for ids, w in ways(whole)}
    total = sum(weight.values())
    return {ids: w / total for ids, w in weight.items()}


def draws(texts, k, keys=None, most=100_000):
    v = small()
    return segmentation.top_k(keys or list(range(len(texts))), texts, k, Known(v, most))


@pytest.mark.parametrize("text", ["ab", "aba ab", "a  bab", "éab", "x", "ab\nab a"])
def test_all_segmentations_come_once(text):
    v, expected = small(), enumerated(text, small())
    (found,) = draws([text], len(expected) + 5)
    assert len(found) == len(expected)
    got = {tuple(ids.tolist()): logp for ids, logp, _ in found}
    assert got.keys() == expected.keys()
    assert all(math.exp(got[ids]) == pytest.approx(p) for ids, p in expected.items())
    assert all(inclusion == 0 for *_, inclusion in found)


def test_draws_are_without_replacement():
    text, n = "aba ab", 6000
    p = enumerated(text, small())
    found = [[tuple(ids.tolist()) for ids, *_ in s] for s in draws([text] * n, 2)]
    first, pairs = Counter(s[0] for s in found), Counter(map(tuple, found))
    for ids, share in p.items():
        assert first[ids] / n == pytest.approx(share, abs=4 * math.sqrt(share / n) + 1e-3)
    for a, b in itertools.permutations(p, 2):
        share = p[a] * p[b] / (1 - p[a])
        assert pairs[a, b] / n == pytest.approx(share, abs=4 * math.sqrt(share / n) + 1e-3)


def test_inclusion_scores_weigh_samples():
    """Weighted by 1 / inclusion, the drawn probabilities add up to one on average."""
    sums = [sum(math.exp(logp - inclusion) for _, logp, inclusion in s) for s in draws(["abab a"] * 4000, 3)]
    assert np.mean(sums) == pytest.approx(1, abs=0.03)


def test_batches_and_known_units_do_not_matter():
    texts = ["ab a", "", "aba é ab", "b" * 50, "ab " * 300, "a\n\nb"] * 3
    keys = list(range(len(texts)))
    together = draws(texts, 3)
    v = small()
    known = Known(v, 2)
    for i in keys[::-1]:
        (alone,) = segmentation.top_k([i], [texts[i]], 3, known)
        assert [(a[0].tolist(), *a[1:]) for a in alone] == [(a[0].tolist(), pytest.approx(a[1]), pytest.approx(a[2])) for a in together[i]]
    assert len(known.index) <= 2


def test_long_units_and_texts():
    (found,) = draws(["ab" * 5000 + " " + "é" * 2000 + " ab" * 20000], 2)
    for ids, logp, inclusion in found:
        assert segmentation.restore(segmentation.decoded(small()), ids.tolist()).startswith("abab")
        assert logp < -100 and inclusion < -100
    assert found[0][0].tolist() != found[1][0].tolist()


def test_units():
    units, each = small().cut(["a  b\n\tc▁d ", "", "\n", "  ", "é x"])
    assert [u.decode() for u in units.to_pylist()] == [" a", "  b", "\n", "\t", "c", " d", " ", " ", "\n", "   ", " é", " x"]
    assert each.tolist() == [7, 0, 2, 1, 2]


def test_known_units_are_numbered_on():
    known = Known(small())
    known.of(["ab ab x é é", ""])
    assert list(known.index) == [b" ab", " é".encode()]
    (ids, none), lattice = known.of(["aba é a ab", ""])
    assert ids.tolist() == [2, 1, 3, 0] and none.tolist() == []
    whole = Lattice(["▁ab", "▁é", "▁aba", "▁a"], small())
    for name in ("first", "last", "start", "piece", "logp"):
        assert (getattr(lattice, name) == getattr(whole, name)).all()
    assert (lattice.edges[lattice.last] == whole.edges[whole.last]).all()
    assert lattice.bare == whole.bare


@pytest.mark.skipif(not os.path.exists(MODEL), reason="vocabulary files are not here")
def test_rows(spark):
    import sentencepiece

    texts = {1: "Hello wörld,  it is\n\t名 \U0001f600.", 2: None, 3: "", 4: " ", 5: "long words " * 30_000, 6: "a▁b", 7: "\x00 x"}
    rows = [(i, t, "x", "y") for i, t in [*texts.items(), (None, "no key"), (1, texts[1])]]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = segmentation.encode(docs, MODEL, k=3).collect()
    assert all(r["round_trip"] for r in found)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in found:
        text = "no key" if r["doc_id"] is None else (texts[r["doc_id"]] or "").replace(SPACE, " ")
        assert model.decode(r["pieces"]) == text
    samples = Counter(r["doc_id"] for r in found)
    assert samples[2] == samples[3] == 1 and samples[1] == 6 and samples[5] == 3
    distinct = {(r["doc_id"], tuple(r["pieces"])) for r in found}
    assert len(distinct) == len(found) - 3  # the row that is there twice has the same samples twice
    again = segmentation.encode(docs.repartition(4), MODEL, k=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    back = segmentation.decode(spark.createDataFrame(found), MODEL).collect()
    assert Counter(r["text"] for r in back)[texts[5]] == 3
    odd = spark.createDataFrame([(1, None), (2, [None, 10**6]), (3, [])], "doc_id long, pieces array<int>")
    assert [r["text"] for r in segmentation.decode(odd, MODEL).collect()] == ["", "", ""]
    assert segmentation.encode(docs.where("false"), MODEL).collect() == []


def test_pieces_joined_in_arrow_are_those_decoded_one_by_one():
    table = segmentation.decoded(small())
    rng = np.random.default_rng(3)
    runs = [rng.integers(0, len(table), n) for n in (0, 5, 1, 300, 0)]
    texts = [segmentation.restored(table, r.tolist()) for r in runs]
    arrow, sizes, flat = pa.array(table, pa.binary()), [len(r) for r in runs], np.concatenate(runs)
    assert segmentation.gives_back(arrow, flat, sizes, texts) == [True] * 5
    assert segmentation.gives_back(arrow, flat, sizes, [t + b"x" for t in texts]) == [False] * 5
    assert segmentation.gives_back(arrow, flat[:0], [0, 0], [b"", b"a"]) == [True, False]
