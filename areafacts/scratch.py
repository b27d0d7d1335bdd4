"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Stands in for the cluster's setting in a session on one machine.
LOCAL_DIR = "areafacts.local.dir"

_own: tempfile.TemporaryDirectory | None = None


def folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``; without the setting, an error."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(LOCAL_DIR, None)
    if not base:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors can reach")
    return f"{base.rstrip('/')}/areafacts/{purpose}-{uuid.uuid4().hex}"


def use_local_folder(spark: SparkSession) -> None:
    """For trials: where the setting is missing and everything runs in one process, a folder that goes with it.

    A cluster's session (``local-cluster`` is one) is left alone, so a missing setting stays an error there.
    """
    global _own
    if spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(LOCAL_DIR, None):
        return
    if re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        _own = _own or tempfile.TemporaryDirectory(prefix="areafacts-", ignore_cleanup_errors=True)
        spark.conf.set(LOCAL_DIR, _own.name)


def written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` computed once and read back as columnar files, with their path.

    Cuts lineage at a written table: losing an executor later re-reads files
    and never recomputes an order-dependent step with another outcome.
    """
    path = folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _storage(spark: SparkSession, path: str):
    """(file system, path) objects of the storage behind ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _storage(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that are no longer read."""
    for path in paths:
        fs, target = _storage(spark, path)
        fs.delete(target, True)
