"""Keyed table as plain partitioned Parquet, merged by dynamic partition overwrite.

A merge stages its batch, reads the partitions the batch touches, and writes them once: Spark puts the new partitions
beside the table and moves them in when all tasks are done, so a failed job or a lost executor leaves the table as it was.
A merge done again gives the same table, which is how one is repaired whose driver died while partitions were moved in
(they lie in ``.spark-staging-*`` under ``data`` then). One writer at a time; a reader that holds replaced files reads anew.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts import scratch
from areafacts.operators.changes import changes
from areafacts.operators.upsert import upsert

BUCKET = "bucket"
# Which micro-batch brought a row whose key has a null: a replay finds its own rows by it.
_BATCH = "_batch"


class KeyedTable:
    """One keyed table under ``root``.

    ``partition_by`` is an expression over the key columns only, such as the year of a key date, so that a row never
    changes its partition; its values may be any text. Without it the table is one partition.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], partition_by: Column | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.partition_by = partition_by

    def schema(self) -> T.StructType | None:
        """The table's columns; nothing if there is no table."""
        if not scratch.exists(self.spark, f"{self.root}/schema"):
            return None
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}/schema", wholetext=True).head()[0]))

    def ensure(self, schema: T.StructType) -> bool:
        """Create the empty table if there is none; true if it was created."""
        if self.schema() is not None:
            return False
        self._describe(schema)
        return True

    def read(self) -> DataFrame:
        """The current content of the table."""
        return self._stored().drop(BUCKET, _BATCH)

    def register_view(self, name: str) -> None:
        """Name the content for SQL text."""
        self.read().createOrReplaceTempView(name)

    def partitions(self) -> list[str]:
        """Values of the partitions that hold rows."""
        return sorted(r[0] for r in self._stored().select(BUCKET).distinct().collect())

    def merge(
        self,
        source: DataFrame,
        null_safe: bool = False,
        evolve: bool = False,
        batch: str | None = None,
        log: str | None = None,
    ) -> list[str]:
        """Upsert ``source`` by the keys; returns the partitions that were written.

        ``batch`` names a delivery that may come again. Rows with a null in their key match nothing, so a second merge
        would add them; those that the same ``batch`` added before are replaced. ``log`` is a path for the change set
        (see :func:`areafacts.operators.changes.changes`). It is written before the table is; one that is there already
        is of a merge that was cut short after it, and stays.
        """
        if self.partition_by is not None:
            source.select(*self.keys).select(self.partition_by)  # fails unless it is a function of the key
        self.ensure(source.schema)
        keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        marks = {BUCKET: self._bucket(), _BATCH: F.when(keyless & F.lit(not null_safe), F.lit(batch).cast("string"))}
        rows, staged = scratch.written(source.withColumns(marks), "batch")
        try:
            touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # as many as folders at most
            if touched:
                target = self._stored().where(F.col(BUCKET).isin(touched))
                if batch is not None:
                    target = target.where(~(keyless & F.col(_BATCH).eqNullSafe(F.lit(batch))))
                if log is not None and not scratch.exists(self.spark, f"{log}/_SUCCESS"):
                    internal = (BUCKET, _BATCH)
                    changes(target.drop(*internal), rows.drop(*internal), self.keys, null_safe).write.mode("overwrite").parquet(log)
                result = upsert(target, rows, self.keys, null_safe, evolve)
                if evolve:
                    self._describe(result.drop(BUCKET, _BATCH).schema)
                self._write(result)
        finally:
            scratch.remove(self.spark, staged)
        return touched

    def _stored(self) -> DataFrame:
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"nothing has been merged into {self.root} yet")
        whole = T.StructType([*schema.fields, T.StructField(_BATCH, T.StringType()), T.StructField(BUCKET, T.StringType())])
        if not scratch.exists(self.spark, f"{self.root}/data"):
            return self.spark.createDataFrame([], whole).limit(0)  # known to be empty when planned: no join with it
        # files older than a new column lack it: read as null
        return self.spark.read.schema(whole).parquet(f"{self.root}/data")

    def _bucket(self) -> Column:
        if self.partition_by is None:
            return F.lit("all")
        text = self.partition_by.cast("string")
        return F.when(text != "", text).otherwise("none")  # an empty folder name would read as null

    def _write(self, rows: DataFrame) -> None:
        """Replace the partitions of ``rows``. Rebalancing gathers each, splits one too big for a task, joins small ones."""
        gathered = rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET)
        gathered.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/data")

    def _describe(self, schema: T.StructType) -> None:
        if schema != self.schema():
            text = self.spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string")
            text.coalesce(1).write.mode("overwrite").text(f"{self.root}/schema")
