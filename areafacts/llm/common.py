"""Column expressions and shared-folder helpers of the training-data operators."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areafacts import scratch

# White space of every word rule here: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Python workers that start from now on look for this package where the driver found it, too."""
    root, environment = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def fold(id_column: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that no other column can clash."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder."""
    return scratch.written(df, purpose)[0]


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal values in a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def smallest(df: DataFrame, group: str, order: list[str], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group; cut in salted parts first, so that no task gets n rows from every other."""
    for keys in ([group, F.pmod(F.xxhash64(*order), F.lit(salts))], [group]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        df = df.withColumn("__n", rank).where(F.col("__n") <= n).drop("__n")
    return df
