"""Approximate nearest neighbours by randomly rotated one-bit codes.

The index holds, for every vector, the signs of its rotated direction from the mean (one bit a dimension, packed), its
distance from the mean and the inner product of the direction with its own code. A query's inner product with a vector
is estimated from the code; the correction by that inner product makes the estimate unbiased, and a multiple of its
standard error bounds it. Pass one reads codes only and finds, for each query, the k-th smallest upper bound over all
vectors. Pass two reranks, by exact distance on the original vectors, whatever has a lower bound at or below it. A
neighbour is missed only where the bound fails. A pair whose bound leaves the range of doubles is reranked.

Every vector is indexed and every candidate gets an estimate; queries go in blocks. A task sends k bounds or hits for
each query of a block, so hot regions and copies do not add to the shuffle.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components takes no part, nor does a
null id. A query meets vectors of its own length, except rows of its own id. Repeated rows of another id are all
candidates; repeated query rows are one query. Fewer than k candidates are all returned. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.llm import vectors as V

# Vectors with larger components have no part in the centre: their squares would leave the range of doubles.
HUGE = 1e100
# Standard errors that the bound allows for; the estimate's tail is Gaussian.
CONFIDENCE = 3.0
SEED = 20240131

INDEX = "id long, vector array<double>, code binary, norm double, own double"


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for every task; dimensions are padded to whole bytes."""
    padded = -(-dim // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((padded, padded)))
    return (q * np.sign(np.diag(r)))[:dim]


def mean_vector(rows: DataFrame, dim: int) -> np.ndarray:
    """Mean of the vectors of one length without HUGE components; tasks send one partial sum each."""
    schema = pa.schema([("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def add(batches):
        n, total = 0, np.zeros(dim)
        for b in V.slices(batches):
            m = V.matrix(b.column("vector"))
            m = m[np.abs(m).max(axis=1) <= HUGE] if len(m) else m
            n, total = n + len(m), total + (m / 2.0**10).sum(axis=0) if len(m) else total
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], schema.field(1).type)], schema=schema)

    sums = rows.select("vector").mapInArrow(add, "n long, total array<double>")
    parts = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dim)]
    first = sums.agg(F.sum("n").alias("n"), *parts).first()
    mean = np.array([first[f"s{i}"] or 0.0 for i in range(dim)]) / max(first["n"] or 0, 1) * 2.0**10
    return np.where(np.isfinite(mean), mean, 0.0)


def index(rows: DataFrame, dim: int, centre: np.ndarray) -> DataFrame:
    """Codes and correction scalars of all vectors of one length, beside the vectors."""
    turn = rotation(dim)
    schema = pa.schema(
        [("id", pa.int64()), ("vector", pa.list_(pa.float64())), ("code", pa.binary()), ("norm", pa.float64()), ("own", pa.float64())]
    )

    def encode(batches):
        for b in V.slices(batches):
            away = V.matrix(b.column("vector")) - centre
            with np.errstate(over="ignore"):
                norm = np.sqrt((away**2).sum(axis=1))
            turned = (away / np.where(norm > 0, norm, 1)[:, None]) @ turn
            code = np.packbits(turned > 0, axis=1)
            own = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("vector").cast(schema.field(1).type), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(own)],
                schema=schema,
            )

    return rows.mapInArrow(encode, INDEX)


class Bounds:
    """Lower and upper bounds of squared distances between a block of queries and coded vectors."""

    def __init__(self, block: V.Queries, centre: np.ndarray, confidence: float):
        away = block.vectors - centre
        self.norm = np.sqrt((away**2).sum(axis=1))
        turned = (away / np.where(self.norm > 0, self.norm, 1)[:, None]) @ rotation(block.dim)
        self.bits = turned.shape[1]
        self.turned = (turned / np.sqrt(self.bits)).astype(np.float32)
        self.confidence = confidence

    def of(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        packed = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, -1)
        signs = np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1
        norm, own = b.column("norm").to_numpy(), b.column("own").to_numpy()
        safe = np.where(own > 0, own, 1)
        estimate = (self.turned @ signs.T) / safe
        error = self.confidence * np.sqrt(np.maximum(1 - safe**2, 0)) / safe / np.sqrt(max(self.bits - 1, 1)) + 1e-5
        with np.errstate(over="ignore", invalid="ignore"):
            middle = norm**2 + (self.norm**2)[:, None]
            cross = 2 * self.norm[:, None] * norm
            slack = 1e-9 * middle
            lower = middle - cross * np.minimum(estimate + error, 1) - slack
            upper = middle - cross * np.maximum(estimate - error, -1) + slack
        # no bound where a norm is too large
        return np.where(np.isfinite(lower), lower, -np.inf), np.where(np.isfinite(upper), upper, np.inf)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances row by row; scaled first where the squares leave the range of doubles."""
    with np.errstate(over="ignore"):
        away = a - b
        found = np.sqrt((away**2).sum(axis=1))
    large = ~np.isfinite(found)
    if large.any():
        top = np.maximum(np.abs(a[large]).max(axis=1), np.abs(b[large]).max(axis=1))[:, None]
        found[large] = np.sqrt(((a[large] / top - b[large] / top) ** 2).sum(axis=1)) * top[:, 0]
    return found


def _upper(block: V.Queries, centre: np.ndarray, k: int, confidence: float):
    schema = pa.schema([("query", pa.int64()), ("upper", pa.float64())])

    def smallest(batches):
        bounds, best = Bounds(block, centre, confidence), np.full((len(block.ids), k), np.inf)
        for b in V.slices(batches):
            _, upper = bounds.of(b)
            upper[block.ids[:, None] == b.column("id").to_numpy()[None, :]] = np.inf
            if upper.shape[1] > k:
                upper = np.partition(upper, k - 1, axis=1)[:, :k]
            best = np.sort(np.concatenate([best, upper], axis=1), axis=1)[:, :k]
        query, at = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(block.ids[query]), pa.array(best[query, at])], schema=schema)

    return smallest


def _rerank(block: V.Queries, centre: np.ndarray, limit: np.ndarray, k: int, confidence: float):
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def rerank(batches):
        bounds, best = Bounds(block, centre, confidence), V.Best(k)
        for b in V.slices(batches):
            lower, _ = bounds.of(b)
            ids, rows = b.column("id").to_numpy(), V.matrix(b.column("vector"))
            query, row = np.nonzero((lower <= limit[:, None]) & (block.ids[:, None] != ids[None, :]))
            for i in range(0, len(query), 65536):
                q, r = query[i : i + 65536], row[i : i + 65536]
                best.add(block.ids[q], _distances(rows[r], block.vectors[q]), ids[r])
        query, distance, ids = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(distance)], schema=schema)

    return rerank


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found by Euclidean distance for each row where ``is_query`` holds."""
    spark = rows.sparkSession
    folder = scratch.folder(spark, "nearest")
    spark.createDataFrame([], "query_id long, rank int, vec_id long, score double").write.parquet(f"{folder}/none")
    paths = [f"{folder}/none"]
    everyone = V.prepared(rows, id_column, vector_column, nonzero=True)
    indexed: dict[int, tuple[DataFrame, np.ndarray]] = {}
    queries = V.prepared(rows.where(is_query), id_column, vector_column, nonzero=True)
    for i, block in enumerate(V.query_blocks(queries)):
        if block.dim not in indexed:
            same = everyone.where(F.size("vector") == block.dim)
            centre = mean_vector(same, block.dim)
            indexed = {block.dim: (scratch.written(index(same, block.dim, centre), "codes")[0], centre)}
        codes, centre = indexed[block.dim]
        uppers = codes.select("id", "code", "norm", "own").mapInArrow(
            _upper(block, centre, k, confidence), "query long, upper double"
        )
        nth = F.row_number().over(Window.partitionBy("query").orderBy("upper"))
        kth = {r["query"]: r["upper"] for r in uppers.withColumn("n", nth).where(F.col("n") == k).collect()}
        limit = np.array([kth.get(int(q), np.inf) for q in block.ids])  # one value per query of the block
        hits = codes.mapInArrow(_rerank(block, centre, limit, k, confidence), V.HITS.format("double"))
        paths.append(f"{folder}/{i}")
        V.ranked(hits, k, F.asc("score")).write.parquet(paths[-1])
    return spark.read.parquet(*paths)
