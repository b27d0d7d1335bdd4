"""Whitening of embeddings: covariance from bit-sliced integer cross-products, eigenvectors on the driver.

Components become integers, ``floor(scale * c)``; the fit list is every distinct integer vector once. Each task shifts a
dimension by its minimum, packs every bit plane of the shifted values across rows into 64-bit words, and counts the ones
of the AND of each two planes: the count, weighted by the planes' powers of two, is the exact sum of products. A plane of
ones stands beside them, so that its products are the dimensions' sums and the number of rows. Tasks send their sums in
limbs of 32 bits, Spark adds them, and what reaches the driver is one (dim + 1) x (dim + 1) matrix of integers. It is
centred as integers, ``n * C - S S'``, which no shift changes, before it is divided and given to ``eigh``.

Defined cases: a row whose vector is null, empty or holds a null or non-finite component is dropped. Components saturate
at 2^62. Repeated rows (and a null id) each keep their rows in the result and count once in the fit. Vectors of different
lengths are whitened apart, each length with its own fit list. A component without variance (below 1e-12 of the trace)
has a null ``whitened``; with no variance at all, ``explained`` and ``identity_error`` are null, too. ``deviation`` is
null beyond 2^63 - 1. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areafacts import scratch
from areafacts.llm import vectors as V
from areafacts.llm.common import batch, stored

# Numbers whose planes are packed at once, and at most 65,536 rows (1,024 words a plane).
NUMBERS, ROWS = 2**22, 2**16
# Bytes of one AND of planes.
AT_ONCE = 2**20
# Powers of two that are added up as a plain integer: counts of 2^16 rows weigh less than 2^48 a time.
_DIGIT = 16
_LIMB = 32

OUT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(df: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, x): the rows that take part, as integers."""
    top = float(2**62)
    rows = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{vector_column}`"].cast("array<double>").alias("vector"))
    x = F.transform("vector", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(top)), F.lit(-top))).cast("long"))
    return rows.where(V.usable(F.col("vector"), nonzero=False)).select("id", x.alias("x"))


def _matrices(batches):
    """The vectors as arrays of at most ROWS rows, whatever the sizes of the batches."""
    held: list[np.ndarray] = []
    for b in batches:
        held.append(V.matrix(b.column("x")))
        rows = max(64, min(ROWS, NUMBERS // max(1, held[-1].shape[1])))
        while sum(map(len, held)) >= rows:
            together = np.concatenate(held)
            yield together[:rows]
            held = [together[rows:]]
    if sum(map(len, held)):
        yield np.concatenate(held)


def _ranges(batches):
    schema = pa.schema([("i", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])
    low = high = None
    for x in _matrices(batches):
        low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
        high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if low is not None:
        yield batch(schema, np.arange(len(low)), low, high)


def planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the shifted values, dimension after dimension, lowest bit first; the last one is all ones.

    Rows are bits of little-endian words; those beyond the last row are zero.
    """
    shifted = (x.astype(np.uint64) - low.astype(np.uint64)).T  # modulo 2^64, so no difference overflows
    found = np.zeros((int(bits.sum()) + 1, -(-len(x) // 64) * 8), np.uint8)
    at = 0
    for values, n in zip(shifted, bits):
        for b in range(int(n)):
            packed = np.packbits(((values >> np.uint64(b)) & np.uint64(1)).astype(bool), bitorder="little")
            found[at, : len(packed)] = packed
            at += 1
    ones = np.packbits(np.ones(len(x), bool), bitorder="little")
    found[at, : len(ones)] = ones
    return found.view(np.uint64)


class Products:
    """Sums of products of every two dimensions, and the ones, from the bit planes of many arrays.

    ``sums[P, Q]`` has the planes of powers 16 P and up with those of 16 Q and up, each count weighted by what its two
    powers have beyond: (dim + 1) x (dim + 1) numbers for each 16 bits squared, in the upper triangle.
    """

    def __init__(self, bits: np.ndarray) -> None:
        bits = np.append(bits, 1)
        self.dim = np.repeat(np.arange(len(bits)), bits)
        self.power = np.concatenate([np.arange(n) for n in bits])
        self.first = np.cumsum(bits) - bits  # of each dimension's planes
        digits = range(int(self.power.max()) // _DIGIT + 1)
        self.sums = {(p, q): np.zeros((len(bits), len(bits)), np.int64) for p in digits for q in digits}

    def add(self, words: np.ndarray) -> None:
        digit, weight = self.power // _DIGIT, np.int64(1) << (self.power % _DIGIT)
        step = max(1, AT_ONCE // max(1, words[0].nbytes))
        for i in range(len(words)):
            a, start = self.dim[i], self.first[self.dim[i]]
            ones = [
                np.bitwise_count(words[j : j + step] & words[i]).sum(axis=1, dtype=np.int64)
                for j in range(start, len(words), step)
            ]
            counts = np.concatenate(ones) * weight[start:] * weight[i]
            for q in range(int(digit[start:].max()) + 1):
                here = np.flatnonzero(digit[start:] == q) + start
                if len(here):
                    edges = np.flatnonzero(np.diff(self.dim[here], prepend=-1))
                    self.sums[digit[i], q][a, self.dim[here][edges]] += np.add.reduceat(counts[here - start], edges)

    def total(self) -> np.ndarray:
        """The upper triangle as Python integers."""
        return sum(part.astype(object) << (_DIGIT * (p + q)) for (p, q), part in self.sums.items())


def _cross(low: np.ndarray, bits: np.ndarray):
    """A task's sums of products, cut into limbs of 32 bits."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])

    def sums(batches):
        found, any_rows = Products(bits), False
        for x in _matrices(batches):
            found.add(planes(x, low, bits))
            any_rows = True
        if not any_rows:
            return
        total = found.total()
        i, j = np.triu_indices(len(total))
        values, limb = total[i, j], 0
        while values.any():
            part = (values & ((1 << _LIMB) - 1)).astype(np.int64)
            some = np.flatnonzero(part)
            yield batch(schema, i[some], j[some], np.full(len(some), limb), part[some])
            values, limb = values >> _LIMB, limb + 1

    return sums


@dataclass
class Fit:
    """Of one length: rows of the fit list, their sums, eigenvalues falling, eigenvectors as columns, explained shares."""

    n: int
    sums: np.ndarray  # Python integers
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def varies(self) -> np.ndarray:
        return self.values > 1e-12 * self.trace


def fit(distinct: DataFrame) -> Fit:
    """Exact sums over the rows (x) of one length, and the eigenvectors of their covariance."""
    found = distinct.mapInArrow(_ranges, "i int, low long, high long")
    ranges = found.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    low = np.array([r["low"] for r in ranges], np.int64)
    bits = np.array([(r["high"] - r["low"]).bit_length() for r in ranges], np.int64)
    parts = distinct.mapInArrow(_cross(low, bits), "i int, j int, limb int, value long")
    d = len(low)
    total = np.zeros((d + 1, d + 1), object)
    summed = parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).toArrow()
    for i, j, limb, value in zip(*(c.to_pylist() for c in summed.columns)):
        total[i, j] += value << (_LIMB * limb)
    total = np.triu(total) + np.triu(total, 1).T
    n, shifted = int(total[d, d]), total[:d, d]
    centred = n * total[:d, :d] - np.outer(shifted, shifted)  # integers: n^2 times the covariance
    covariance = np.array([[c / (n * n) for c in row] for row in centred], float).reshape(d, d)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    return Fit(n, shifted + n * low.astype(object), values, axes, float(np.trace(covariance)))


def _whitened(model: Fit, k: int):
    """(rows, k) whitened components of integer vectors, null where a component has no variance."""
    whole = np.array([int(s) // model.n for s in model.sums], np.int64)
    rest = np.array([(int(s) % model.n) / model.n for s in model.sums])
    ok = model.varies[:k]
    scale = np.where(ok, 1 / np.sqrt(np.where(ok, model.values[:k], 1)), np.nan)

    def of(x: np.ndarray) -> np.ndarray:
        return (((x - whole).astype(float) - rest) @ model.axes[:, :k]) * scale

    return of


def deviations(x: np.ndarray, model: Fit) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2; computed modulo 2^64, so exact wherever it fits a long."""
    sums = np.array([int(s) & (2**64 - 1) for s in model.sums], np.uint64)
    y = x.astype(np.uint64) * np.uint64(model.n % 2**64) - sums
    exact = (y * y).sum(axis=1, dtype=np.uint64)
    about = ((x.astype(float) * model.n - model.sums.astype(float)) ** 2).sum(axis=1)
    return [int(e) if a < 2.0**63 and e < 2**63 else None for e, a in zip(exact, about)]


def identity_error(distinct: DataFrame, model: Fit, k: int) -> float | None:
    """Largest entry by which the whitened fit list's covariance, summed over all tasks, differs from the identity."""
    used = np.flatnonzero(model.varies[:k])
    if not len(used):
        return None
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])

    def products_of(batches):
        of, total = _whitened(model, k), np.zeros((len(used) + 1, len(used) + 1))
        for x in _matrices(batches):
            w = np.c_[of(x)[:, used], np.ones(len(x))]
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        yield batch(schema, i, j, total.ravel())

    total = np.zeros((len(used) + 1, len(used) + 1))
    found = distinct.mapInArrow(products_of, "i int, j int, value double")
    for r in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] = r["value"] / model.n
    mean = total[-1, :-1]  # zero but for rounding: the vectors were centred before
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(used))).max())


def _rows(model: Fit, k: int, error: float | None):
    names = [("id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
    schema = pa.schema([*names, *[(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]])
    share = [None if model.trace <= 0 else float(e / model.trace) for e in model.values[:k]]

    def of_all(batches):
        of = _whitened(model, k)
        for b in V.slices(batches):
            x, m = V.matrix(b.column("x")), len(share)
            w = of(x).ravel()
            yield batch(
                schema,
                b.column("id").take(pa.array(np.repeat(np.arange(len(x)), m))),
                np.tile(np.arange(1, m + 1), len(x)),
                np.full(len(x) * m, model.n),
                pa.array([d for d in deviations(x, model) for _ in range(m)], pa.int64()),
                pa.array(w, pa.float64(), mask=np.isnan(w)),
                pa.array(share * len(x), pa.float64()),
                pa.array([error] * (len(x) * m), pa.float64()),
            )

    return of_all


def whiten(
    df: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of each row and component."""
    spark = df.sparkSession
    x = integers(df, id_column, vector_column, scale)
    distinct = stored(x.select("x").distinct(), "fit")
    folder = scratch.folder(spark, "whitened")
    spark.createDataFrame([], OUT).write.parquet(f"{folder}/none")
    paths = [f"{folder}/none"]
    for row in distinct.groupBy(F.size("x").alias("d")).count().orderBy("d").collect():  # one row a length
        mine = F.size("x") == row["d"]
        fitted = distinct.where(mine)
        model, k = fit(fitted), min(components, row["d"])
        error = identity_error(fitted, model, k)
        paths.append(f"{folder}/{row['d']}")
        x.where(mine).mapInArrow(_rows(model, k, error), OUT).write.parquet(paths[-1])
    return spark.read.schema(OUT).parquet(*paths).withColumnRenamed("id", id_column)
