"""Named views and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_view(df: DataFrame, name: str) -> None:
    """Make ``df`` available to SQL text of its session under ``name``."""
    df.createOrReplaceTempView(name)


def ensure_target(df: DataFrame, table: str) -> bool:
    """Create the empty catalog table with the columns of ``df`` if it is absent."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    df.limit(0).write.saveAsTable(table)
    return True


def merge_into(source: DataFrame, table: str, keys: Sequence[str], evolve: bool = False) -> None:
    """Upsert into a catalog table whose format supports row-level merges.

    Plain Parquet tables do not; keep those in a ``KeyedTable``.
    """
    batch = source.alias("source")
    on = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys])
    writer = batch.mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll()
    if evolve:
        writer = writer.withSchemaEvolution()
    writer.merge()


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as a catalog table hashed and sorted by ``keys``, one file a bucket; returns the table.

    Tables with equally typed keys and the same number of buckets are joined and grouped by them without a shuffle.
    ``path`` puts the files there.
    """
    keys = list(keys)
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return df.sparkSession.table(table)


def save_clustered(
    df: DataFrame, path: str, column: str, files: int, distinct: int | None = None, group_bytes: int = 16 * 1024**2
) -> None:
    """Store ``df`` as Parquet in ranges of ``column``, so that a filter on it skips files and row groups by their bounds.

    ``distinct`` values a row group are expected for a Bloom filter, which also tells what lies between the bounds from
    what is there; without it none is written. Small row groups skip more and pack less.
    """
    writer = df.repartitionByRange(files, column).sortWithinPartitions(column).write.mode("overwrite")
    writer = writer.option("parquet.block.size", group_bytes)
    if distinct is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def row_groups(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``file, row_group, n_rows, low, high`` of stored Parquet files: the bounds that filters on ``column`` go by.

    Each file's footer is read in a task.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq

    def footers(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                meta = pq.read_metadata(pa.BufferReader(content))
                for i in range(meta.num_row_groups):
                    group = meta.row_group(i)
                    at = next(j for j in range(group.num_columns) if group.column(j).path_in_schema == column)
                    stats = group.column(at).statistics
                    low, high = (float(stats.min), float(stats.max)) if stats and stats.has_min_max else (None, None)
                    yield pa.RecordBatch.from_pylist(
                        [{"file": name, "row_group": i, "n_rows": group.num_rows, "low": low, "high": high}], schema=schema
                    )

    schema = pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("n_rows", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "content")
    return files.mapInArrow(footers, "file string, row_group int, n_rows long, low double, high double")
