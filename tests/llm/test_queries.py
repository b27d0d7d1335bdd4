"""The registered queries on the smallest tables: their columns, and their rows by brute force or SQL."""

import hashlib
import os
import re
import zlib

import pytest

import __spark_entry__ as entry
from areafacts.llm import queries, secrets, segmentation
from areafacts.llm.lattice import SPACE
from areafacts.llm.oracle import ORACLE
from tests.llm.test_lm_scoring import expected as scored
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash import expected as fingerprinted
from tools.compare import difference, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_rotated_codes": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6_exact_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_substring_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_cover_tree": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def found(spark, name):
    return sorted((tuple(r) for r in queries.QUERIES[name](spark, SF).collect()), key=str)


def test_all_are_registered():
    names = entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n.startswith("op")} == {str(n) for n in range(1, 14)}
    assert "pipeline" in names and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {kind}" for c, kind in df.dtypes).startswith(COLUMNS[name])


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    problem, rows = difference(spark, duck(SF), SF, name)
    assert problem is None and rows > 0


def test_secrets(spark, docs):
    wanted = {}
    for i, text, _ in docs:
        base = secrets.in_order(plain_base(text or ""))
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        wanted[i] = (i, *(sum(s[2] == k for s in base) for k in secrets.KINDS[:3]), digest)
    rows = found(spark, "op5_secrets")
    assert {r[0]: r[:5] for r in rows} == wanted and len(rows) == len(docs)


def test_segmentation_decodes_to_every_text(spark, docs):
    """Two different samples of every text (one of an empty one), each of which gives it back."""
    rows = queries.QUERIES["op2_segmentation"](spark, SF)
    text = {i: (t or "").replace(SPACE, " ") for i, t, _ in docs}
    samples = {}
    for r in rows.collect():
        assert r["round_trip"] and r["n_pieces"] == len(r["pieces"]) and r["log_probability"] <= 0
        samples.setdefault(r["doc_id"], set()).add(tuple(r["pieces"]))
    assert set(samples) == set(text) and all(len(samples[i]) == (2 if text[i] else 1) for i in text)
    back = segmentation.decode(rows, queries.PIECES).collect()
    assert len(back) == sum(map(len, samples.values())) and all(r["text"] == text[r["doc_id"]] for r in back)


def test_simhash(spark, docs):
    assert found(spark, "op9_simhash") == fingerprinted([(i, t) for i, t, _ in docs])


def test_lm_scoring(spark, docs):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in docs}
    wanted = sorted(scored([(i, t) for i, t, _ in docs], lambda i: not held[i]), key=str)
    rows = found(spark, "op10_lm_scoring")
    for r, w in zip(rows, sorted(wanted, key=lambda w: str((w[0], held[w[0]])))):
        assert r[:5] == (w[0], held[w[0]], *w[1:4])
        assert r[5] == pytest.approx(w[4], abs=1e-6) and r[6] == pytest.approx(w[5], rel=1e-5)
    assert len(rows) == len(wanted)


def test_mixing(spark, docs):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in docs}
    names = sorted({s for *_, s in docs}, key=lambda s: (s is None, s or ""))
    of = {i: s for i, _, s in docs}
    total = {n: sum(size[i] for i in size if of[i] == n) for n in names}
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    target, free, left = {}, set(names), sum(size.values())
    while free:
        share = left / sum(weight[n] for n in free)
        over = {n for n in free if share * weight[n] > 3 * total[n]}
        target |= {n: 3.0 * total[n] for n in over} or {n: share * weight[n] for n in free}
        left -= sum(target[n] for n in over)
        free = free - over if over else set()
    taken = dict.fromkeys(names, 0)
    for i, n, source_size, wanted, words in found(spark, "op4_mixing"):
        assert (n, source_size) == (size[i], total[of[i]]) and wanted == pytest.approx(target[of[i]])
        assert words <= 3 * n
        taken[of[i]] += words
    for name in names:
        assert abs(taken[name] - target[name]) <= max(size[i] for i in size if of[i] == name)
