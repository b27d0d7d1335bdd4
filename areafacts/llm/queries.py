"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areafacts.llm import cover_tree, exact_topk, language_id, lm_scoring, merkle, mixing, rotated_codes, secrets, segmentation, simhash, substring_dedup, toxicity, whitening
from areafacts.llm.common import fold, importable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark, sf_dir):
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op3_rotated_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return rotated_codes.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


@query
def op6_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.exact_topk(vectors, F.col("vec_id") % 100 == 0, k=10)


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


@query
def op5_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op4_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), lambda names: [i % 3 + 1 for i in range(len(names))])
    listed = [(name, size, target) for name, (size, target) in mixed.sources.items()]
    sources = spark.createDataFrame(listed, "source string, source_size long, target double")
    rows = mixed.rows.withColumn("of", F.col("sources")[0])
    return rows.join(sources, F.col("of").eqNullSafe(F.col("source"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = language_id.learn(docs, ~held_out)
    found = language_id.label(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_positions", "label_share")


@query
def op7_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    found = toxicity.score(docs, toxicity.learn(docs, labels, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "toxic_spans")


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op2_segmentation(spark, sf_dir):
    return segmentation.encode(table(spark, sf_dir, "documents"), PIECES, k=2, alpha=0.5)


@query
def op10_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 10) == 0
    found = lm_scoring.score(docs, lm_scoring.learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup(table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)


@query
def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": changed})


@query
def op11_cover_tree(spark, sf_dir):
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)
