"""Exact top-k search by distributed histogram selection.

Scores are integer inner products of quantized vectors. For a block of queries every candidate is scored; each task
counts the scores of a query in the bins of that query's current range, the counts are summed over all tasks, and the
bin that holds the k-th largest score becomes the next range, until it is one integer wide. A last pass keeps what
reaches that value and breaks ties by the smaller id.

A task sends only its top bins, down to where its own count reaches k: the k-th value of the whole is never below the
k-th value of a part. So a pass shuffles at most k rows for each query and task, however the scores are spread.

Defined cases: a vector that is null, empty, or holds null or non-finite components takes no part, nor does a null id.
A query meets candidates of its own length, except rows of its own id. Repeated rows of another id are all candidates;
repeated query rows are one query. Fewer than k candidates are all returned. Quantized components saturate at 2^62 and
scores wrap like any 64-bit integer. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.llm import vectors as V

BINS = 2048


def quantized(values: np.ndarray, quantum: int) -> np.ndarray:
    return np.clip(np.floor(values * quantum), -(2.0**62), 2.0**62)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(queries, rows) integer inner products; by floating point where every partial sum is exact."""
    if not rows.size or not queries.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if np.abs(queries).max() * np.abs(rows).max() * rows.shape[1] < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


def _counts(block: V.Queries, quantum: int, low: np.ndarray, high: np.ndarray, width: np.ndarray, need: np.ndarray):
    """Tasks' top bins of each query's range [low, high)."""
    schema = pa.schema([("query", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def count(batches):
        found = np.zeros((len(block.ids), BINS), np.int64)
        queries = quantized(block.vectors, quantum)
        for b in V.slices(batches):
            s = scores(queries, quantized(V.matrix(b.column("vector")), quantum))
            bins = (s - low[:, None]) // width[:, None]
            ok = (s >= low[:, None]) & (s < high[:, None]) & (block.ids[:, None] != b.column("id").to_numpy()[None, :])
            flat = (np.arange(len(block.ids))[:, None] * BINS + bins)[ok]
            found += np.bincount(flat, minlength=found.size).reshape(found.shape)
        from_top = np.cumsum(found[:, ::-1], axis=1)[:, ::-1]
        query, at = np.nonzero((found > 0) & (from_top - found < need[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(at), pa.array(found[query, at])], schema=schema)

    return count


def _reaching(block: V.Queries, quantum: int, floor: np.ndarray, k: int):
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def keep(batches):
        best, queries = V.Best(k), quantized(block.vectors, quantum)
        for b in V.slices(batches):
            ids = b.column("id").to_numpy()
            s = scores(queries, quantized(V.matrix(b.column("vector")), quantum))
            query, row = np.nonzero((s >= floor[:, None]) & (block.ids[:, None] != ids[None, :]))
            best.add(block.ids[query], -s[query, row], ids[row])
        query, key, ids = best.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ids), pa.array((-key).astype(np.int64))], schema=schema
        )

    return keep


def longest_vector(rows: DataFrame, quantum: int) -> float:
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x * quantum), 2)))
    return rows.agg(F.max(norm)).first()[0] or 0.0


def kth_values(rows: DataFrame, block: V.Queries, k: int, quantum: int, longest: float) -> np.ndarray:
    """The k-th largest score of each query, or the least possible one where there are fewer candidates.

    No score exceeds the product of two lengths, which gives the first range.
    """
    reach = np.linalg.norm(quantized(block.vectors, quantum), axis=1) * longest * (1 + 1e-9) + 1
    low = -np.ceil(np.minimum(reach, 2.0**62)).astype(np.int64)
    width = -(2 * low) // BINS + 1
    high = low + BINS * width
    need = np.full(len(block.ids), k, np.int64)
    from_top = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    while True:
        counted = rows.mapInArrow(_counts(block, quantum, low, high, width, need), "query long, bin long, n long")
        limits = rows.sparkSession.createDataFrame(
            [(i, int(n)) for i, n in enumerate(need)], "query long, need long"
        )
        summed = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).withColumn("sum", F.sum("n").over(from_top))
        hit = (
            summed.join(limits, "query")
            .where((F.col("sum") >= F.col("need")) & (F.col("sum") - F.col("n") < F.col("need")))
            .select("query", "bin", (F.col("need") - F.col("sum") + F.col("n")).alias("need"))
        )
        found = {r["query"]: (r["bin"], r["need"]) for r in hit.collect()}  # one row per query of the block
        for i in range(len(block.ids)):
            at, need[i] = found.get(i, (0, need[i]))
            low[i] += at * width[i]
            high[i] = low[i] + width[i] if i in found else low[i]  # fewer than k: all reach low
        if (width == 1).all():
            return low
        width = np.maximum(1, -(-width // BINS))


def exact_topk(
    rows: DataFrame,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    quantum: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest integer inner products of each row where ``is_query`` holds."""
    spark = rows.sparkSession
    folder = scratch.folder(spark, "topk")
    spark.createDataFrame([], "query_id long, rank int, vec_id long, score long").write.parquet(f"{folder}/none")
    paths = [f"{folder}/none"]
    everyone, longest = V.prepared(rows, id_column, vector_column, nonzero=False), {}
    for i, block in enumerate(V.query_blocks(V.prepared(rows.where(is_query), id_column, vector_column, False))):
        same = everyone.where(F.size("vector") == block.dim)
        if block.dim not in longest:
            longest = {block.dim: longest_vector(same, quantum)}
        floor = kth_values(same, block, k, quantum, longest[block.dim])
        hits = same.mapInArrow(_reaching(block, quantum, floor, k), V.HITS.format("long"))
        paths.append(f"{folder}/{i}")
        V.ranked(hits, k, F.desc("score")).write.parquet(paths[-1])
    return spark.read.parquet(*paths)
