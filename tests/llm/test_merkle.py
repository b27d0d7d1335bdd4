"""The manifest against a plain one that keeps whole trees in memory, and a tree that needs several rounds."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from areafacts.llm import merkle, queries

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, at string, block string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = ("-" if c is None else f"{len(str(c).encode())}:{c}" for c in row)
    return sha(*fields)


def levels_above(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climb(built, at, digest):
    siblings = []
    for below in built[:-1]:
        run = below[at // 3 * 3 : at // 3 * 3 + 3]
        siblings += run[: at % 3] + run[at % 3 + 1 :]
        run[at % 3] = digest
        at, digest = at // 3, sha(*run)
    return siblings, digest


def brute(rows, hit):
    """(doc_id, leaf, subroot, root, proof, folded, verified), sorted."""
    trees = {}
    for row in rows:
        text = row[4].replace("\n", "") if row[4] is not None and hit(row[0]) else row[4]
        trees.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0), leaf_of(row), leaf_of((*row[:4], text)), row[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: r[:3])
    built = {name: levels_above([r[1] for r in trees[name]]) for name in names}
    whole = levels_above([built[name][-1][0] for name in names])
    out = []
    for at_top, name in enumerate(names):
        for at, (_, own, changed, id_) in enumerate(trees[name]):
            below, digest = climb(built[name], at, changed)
            above, digest = climb(whole, at_top, digest)
            root = whole[-1][0]
            out.append((id_, own, built[name][-1][0], root, sha(*below, *above), digest, digest == root))
    return sorted(out, key=str)


def even_crc(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0


def found(df, **options):
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(df, FIELDS, {"text": changed}, **options).collect()), key=str)


def test_the_query(spark):
    rows = [tuple(r[c] for c in FIELDS) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = queries.QUERIES["op13_merkle"](spark, SF)
    assert ", ".join(f"{c} {kind}" for c, kind in df.dtypes) == (
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    assert sorted((tuple(r) for r in df.collect()), key=str) == brute(rows, even_crc)


def cases():
    texts = [None, "", "a", "a\nb", "\n", "é世\n" * 3, "x" * 200_000 + "\n"]
    rows = [(i, ["b", "a", None, "é", "z"][i % 5], None if i % 3 else "en", i % 4 or None, texts[i % 7]) for i in range(90)]
    rows += [(1000, "alone", "en", 1, "one\n"), (1001, "", "en", 1, "one")]
    rows += [rows[4]] * 3 + [(6, "a", "en", 1, "other\n"), (None, "a", None, None, "\n\n"), (None, None, None, None, None)]
    return rows


def test_cases(spark):
    rows = cases()
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(7)
    assert found(df) == brute(rows, even_crc)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_few_rows(spark, n):
    rows = [(i, "s", "en", 1, f"{i}\n") for i in range(n)]
    assert found(spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)) == brute(rows, even_crc)


@pytest.mark.parametrize("height,stride", [(1, 1), (2, 3), (3, 2)])
def test_trees_of_several_rounds(spark, height, stride):
    """Units of 3 to 27 nodes: a hot group over many rounds, and more groups than a unit holds."""
    rows = [(i, "hot" if i % 3 else f"s{i % 33:02d}", "en", 1, f"{i}\n{i}") for i in range(240)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    assert found(df, shape=merkle.Shape(3, height, stride)) == brute(rows, even_crc)


def test_levels_of_a_unit():
    nodes = [bytes([i]) * 32 for i in range(7)]
    whole = [[d.hex() for d in level] for level in merkle.levels(nodes, 7, merkle.Shape())]
    assert whole == levels_above([d.hex() for d in nodes])
    assert [len(level) for level in merkle.levels(nodes, 1000, merkle.Shape())] == [7, 3, 1, 1, 1, 1, 1]
