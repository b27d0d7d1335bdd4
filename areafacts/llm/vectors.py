"""What the two vector searches share: blocks of queries, decoded batches, bounded best lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areafacts import scratch

# Queries searched in one pass over the candidates; bounds the broadcast and every list kept by a task.
BLOCK = 1024
# Candidates scored at once by a task: BLOCK x ROWS scores of eight bytes.
ROWS = 2048

HITS = "query long, id long, score {}"


@dataclass
class Queries:
    """One block: ids, vectors of one length."""

    ids: np.ndarray
    vectors: np.ndarray

    @property
    def dim(self) -> int:
        return self.vectors.shape[1]


def usable(vector: Column, nonzero: bool) -> Column:
    """Not null, not empty, no null or non-finite component (and not all zero, if asked)."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    ok = vector.isNotNull() & (F.size(vector) > 0) & finite
    return (ok & F.exists(vector, lambda x: x != 0)) if nonzero else ok


def prepared(df: DataFrame, id_column: str, vector_column: str, nonzero: bool) -> DataFrame:
    """(id, vector of doubles) of the rows that take part: a null id or an unusable vector does not."""
    rows = df.select(
        df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{vector_column}`"].cast("array<double>").alias("vector")
    )
    return rows.where(F.col("id").isNotNull() & usable(F.col("vector"), nonzero))


def query_blocks(queries: DataFrame) -> Iterator[Queries]:
    """Queries of one vector length in blocks of about BLOCK rows, one in memory at a time.

    Repeated rows of one id are one query; with different vectors, the smallest counts.
    """
    spark = queries.sparkSession
    one = queries.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    kept, _ = scratch.written(one, "queries")
    for dim, n in sorted((r["dim"], r["n"]) for r in kept.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        blocks = -(-n // BLOCK)
        for b in range(blocks):
            mine = (F.col("dim") == dim) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
            rows = sorted((r["id"], r["vector"]) for r in kept.where(mine).collect())
            for i in range(0, len(rows), BLOCK):
                part = rows[i : i + BLOCK]
                yield Queries(np.array([r[0] for r in part], np.int64), np.array([r[1] for r in part], float))


def flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal length as one array of doubles."""
    return flat(column).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start in range(0, b.num_rows, ROWS):
            yield b.slice(start, ROWS)


class Best:
    """The ``k`` best hits of each query so far: smallest (key, id); at most ``limit`` rows more in memory."""

    def __init__(self, k: int, limit: int = 1_000_000):
        self.k, self.limit, self.waiting = k, limit, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, query: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((query, key, ids))
        self.waiting += len(query)
        if self.waiting > self.limit:
            self.parts, self.waiting = [self.cut()], 0

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        query, key, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, key, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, query = order[rank < self.k], query[rank < self.k]
        return query, key[order], ids[order]


def ranked(hits: DataFrame, k: int, best_first: Column) -> DataFrame:
    """The ``k`` best of each query among the lists of all tasks (k rows of a query per task at most)."""
    order = Window.partitionBy("query").orderBy(best_first, F.col("id"))
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"
        )
    )
