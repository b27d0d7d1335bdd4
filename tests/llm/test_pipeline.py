"""The pipeline, stage by stage, against brute force on a small fixture with odd rows and planted cases."""

import random
import re

import pytest

import corpus_pipeline
from areafacts import scratch
from areafacts.llm import language_id, secrets
from areafacts.llm.common import fold
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash import brute_components, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, id string"
ENGLISH = "the of and to in that was his with for they this have from word but what some we can out other were all".split()
GERMAN = "der die und den von das mit sich des auf für ist nicht ein eine als auch nach wird schön über wurde".split()


def fixture():
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words, lang = ((ENGLISH, "en"), (GERMAN, "de"))[i % 2]
        text = " ".join(rng.choice(words) + rng.choice(["", "", rng.choice(words)]) for _ in range(rng.randint(30, 200)))
        rows.append([i, text, lang, f"s{i % 4}" if i % 4 else None])
    rows += [[200 + i, rows[i][1], None, "s1"] for i in range(20)]  # exact copies
    rows += [[300 + i, rows[30 + i][1].replace(" ", "  ", 1).upper(), "en", "s2"] for i in range(10)]  # same words
    rows += [[400, None, "en", "s1"], [401, "", "de", None], [402, "12 % 34", None, "s1"], [403, "!" * 3000, "en", "s1"]]
    rows += [[404, rows[5][1] + ' api_key = "q7Zk2LmP9xWv4RtY8uJb3NcD6eHf1GsA" and on', "en", "s3"]]
    rows += [[405, rows[6][1] + " " + "ab12" * 10 + " und mehr", "de", "s3"], [None, rows[7][1] + " alone with no key", "en", "s0"]]
    rows += [rows[3], rows[3], [406, " ".join(rows[8][1].split() * 200), "en", "s0"]]
    return [(i, t, lang, source, None if t is None else len(t), "x", None) for i, t, lang, source in rows]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(fixture(), SCHEMA)
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.written(stage(spark, docs, ""), name)[0]
        out[name] = docs
    return out


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "secrets", "mixture", "pieces"]


def test_columns_stay(stages):
    for name in ("language", "near_copies", "secrets", "mixture"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_language_keeps_what_it_recognizes(stages):
    docs = stages["documents"]
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    kept = []
    for r in docs.collect():
        text = r["text"] or ""
        if any(c.isalpha() for c in text):
            total, _ = language_id.pooled(model.network, [text.encode()])
            if total.max() / len(text.encode()) >= corpus_pipeline.LEAST_SCORE:
                kept.append(tuple(r))
    assert collected(stages["language"]) == sorted(kept, key=str)
    gone = {r["doc_id"] for r in docs.collect()} - {r[0] for r in kept}
    assert gone == {400, 401, 402, 403}


def test_one_document_of_each_group_stays(stages):
    rows = stages["language"].collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    groups = brute_components(list(range(len(rows))), fps, 2)
    best = {}
    for r, g in zip(rows, groups):
        if g not in best or (r["doc_id"] is None, r["doc_id"] or 0) < (best[g]["doc_id"] is None, best[g]["doc_id"] or 0):
            best[g] = r
    assert collected(stages["near_copies"]) == sorted((tuple(r) for r in best.values()), key=str)
    assert len(best) <= len(rows) - 25


def test_secrets_are_gone_and_the_rest_is_unchanged(stages):
    before = {r["doc_id"]: r for r in stages["near_copies"].collect()}
    after = {r["doc_id"]: r for r in stages["secrets"].collect()}
    names = " ".join(secrets.IDENTIFIERS).encode()
    assert before.keys() == after.keys() and stages["secrets"].count() == stages["near_copies"].count()
    changed = 0
    for i, r in before.items():
        covered = bytearray(len(r["text"]))
        for a, b, _ in plain_base(r["text"]) + secrets.novel_spans(r["text"], names):
            covered[a:b] = b"\1" * (b - a)
        mask = "".join("\0" if c else t for t, c in zip(r["text"], covered))
        expected = re.sub("\0+", "<secret>", mask)
        assert after[i]["text"] == expected
        assert after[i]["n_chars"] == len(expected)
        changed += expected != r["text"]
    assert changed == 2


def test_mixture_meets_the_targets(stages):
    before, after = stages["secrets"].collect(), stages["mixture"].collect()
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    names = sorted({r["source"] for r in before}, key=lambda s: (s is None, s or ""))
    sizes = [sum(words(r) for r in before if r["source"] == s) for s in names]
    weights = [i % 3 + 1 for i in range(len(names))]
    longest = max(map(words, before))
    for name, size, weight in zip(names, sizes, weights):
        taken = sum(words(r) for r in after if r["source"] == name)
        if sum(sizes) * weight / sum(weights) <= 3 * size:
            assert taken <= 3 * size
        assert taken <= 3 * size and taken > 0
    assert abs(sum(map(words, after)) - sum(sizes)) <= longest * len(names)
    rows = {tuple(r) for r in before}
    assert all(tuple(r) in rows for r in after)


def test_pieces_decode_to_the_documents(stages):
    rows = stages["pieces"].collect()
    assert all(r["round_trip"] for r in rows)
    texts = {}
    for r in stages["mixture"].collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    assert {r["doc_id"] for r in rows} == set(texts)
    assert len(rows) == 2 * stages["mixture"].count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.written(stage(spark, docs, ""), name)[0]
        assert docs.count() == 0


def test_any_further_column_stays(spark):
    """Columns with the names that stages use inside, in every stage that returns documents."""
    names = ["__readable", "readable", "__id", "__hash", "hash", "__kept", "kept", "__n", "n", "row", "key", "times", "size", "a.b"]
    rows = fixture()[:40] + fixture()[-14:]
    docs = spark.createDataFrame([(*r, *[f"{n}{i}" for n in names]) for i, r in enumerate(rows)], spark.createDataFrame([], SCHEMA).schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", " + ", ".join(f"`{n}` string" for n in names))
    of = {tuple(r): r for r in docs.select("doc_id", "`a.b`").collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = scratch.written(stage(spark, docs, ""), name)[0]
        assert docs.columns[-len(names):] == names, name
        for r in docs.collect():
            tail = r["a.b"].removeprefix("a.b")
            assert [r[n] for n in names] == [f"{n}{tail}" for n in names]
            assert (r["doc_id"], r["a.b"]) in of
    assert docs.count() > 10
