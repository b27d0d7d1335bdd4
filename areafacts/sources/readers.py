"""Feed files: delimited text, JSON lines and wide monthly tables.

Types come from explicit schemas, so no file is scanned twice to guess them. Cells are read as text and cast: a parser
that is given the types turns ``5.0`` in a column of whole numbers into null, and nobody can tell what was there. Every
reader gives the text itself with ``as_text``.
"""

from __future__ import annotations

from typing import TypeVar

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from areafacts.operators.quality import conform
from areafacts.operators.reshape import split_columns
from areafacts.schemas import VALUE_COLUMN_PREFIX

Reader = TypeVar("Reader", DataFrameReader, DataStreamReader)


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a delimited file; reads its first line only."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def as_text_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with numbers and dates as text."""
    kept = (T.ArrayType, T.MapType, T.StructType, T.BooleanType)
    kinds = [f.dataType if isinstance(f.dataType, kept) else T.StringType() for f in schema.fields]
    return T.StructType([T.StructField(f.name, kind, True) for f, kind in zip(schema.fields, kinds)])


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    sep: str = ",",
    extra: str = "keep",
    as_text: bool = False,
) -> DataFrame:
    """Delimited text with a header line.

    Columns are matched to ``schema`` by their header name, whatever their order
    in the file; those it does not name are kept as text (``extra="keep"``) or
    left out (``extra="drop"``), and those the file lacks are absent. A cell
    that does not fit its type is null. All files under ``path`` must have the
    same header; one that differs fails instead of being read by position.
    ``schema=None`` infers the types, at the price of one more scan.
    """
    if extra not in ("keep", "drop"):
        raise ValueError("extra is 'keep' or 'drop'")
    if schema is None:
        return spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    df = _delimited(spark.read, text_schema(header(spark, path, sep)), sep).csv(path)
    if extra == "drop":
        named = {f.name.lower() for f in schema.fields}
        df = df.select(*[c for c in df.columns if c.lower() in named])
    return df if as_text else conform(df, schema)


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    corrupt_col: str = "_corrupt_record",
    as_text: bool = False,
) -> DataFrame:
    """One JSON object per line; fields outside ``schema`` are never built.

    A malformed line keeps its text in ``corrupt_col``, which is null otherwise.
    """
    df = _json_lines(spark.read, schema, corrupt_col).json(path)
    return df if as_text else conform(df, schema)


def wide_schema(names: list[str], id_schema: T.StructType, value_prefix: str = VALUE_COLUMN_PREFIX) -> T.StructType:
    """Schema of a wide table: ids by ``id_schema`` (else text), values double."""
    _, values = split_columns(names, value_prefix)
    known = {f.name.lower(): f.dataType for f in id_schema.fields} | {v.lower(): T.DoubleType() for v in values}
    return T.StructType([T.StructField(n, known.get(n.lower(), T.StringType()), True) for n in names])


def read_wide_index(
    spark: SparkSession,
    path: str,
    id_schema: T.StructType,
    value_prefix: str = VALUE_COLUMN_PREFIX,
    as_text: bool = False,
) -> DataFrame:
    """Comma-separated wide table whose value columns are known only by prefix; all files have one header."""
    names = header(spark, path)
    df = _delimited(spark.read, text_schema(names), ",").csv(path)
    return df if as_text else conform(df, wide_schema(names, id_schema, value_prefix))


def files_under(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime) of the files; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime")


def wide_groups(spark: SparkSession, files: DataFrame, arrived: str = "_arrived") -> list[DataFrame]:
    """Wide tables as text, one for each different header among ``files`` (path, modificationTime).

    Each month's file has a column more than the last one's, so a folder of them has no common schema. ``arrived`` is a
    text by which rows are ordered as their files arrived. Files are listed on the driver, not rows: a delivery has a few.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in files.select("path").distinct().collect():
        groups.setdefault(tuple(header(spark, row["path"])), []).append(row["path"])
    return [
        _delimited(spark.read, text_schema(list(names)), ",").csv(sorted(paths)).withColumn(arrived, arrival())
        for names, paths in sorted(groups.items())
    ]


def arrival() -> Column:
    """Orders rows by their file's time, then its path."""
    return F.concat_ws(" ", F.col("_metadata.file_modification_time").cast("string"), F.col("_metadata.file_path"))


# -- the same files as a stream: a folder into which deliveries are dropped; cells as text ---------


def stream_delimited(
    spark: SparkSession, folder: str, like: str, schema: T.StructType, sep: str = ",", max_files: int | None = None
) -> DataFrame:
    """Files dropped into ``folder``, all with the header of the file ``like``."""
    return _delimited(_stream(spark, max_files), text_schema(header(spark, like, sep)), sep).csv(folder)


def stream_json_lines(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    corrupt_col: str = "_corrupt_record",
    max_files: int | None = None,
) -> DataFrame:
    return _json_lines(_stream(spark, max_files), schema, corrupt_col).json(folder)


def stream_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """(path, modificationTime) of files dropped into ``folder``; their content is not read."""
    source = _stream(spark, max_files or 100).format("binaryFile")
    source = source.schema("path string, modificationTime timestamp, length long, content binary")
    return source.load(folder).select("path", "modificationTime")


def _stream(spark: SparkSession, max_files: int | None) -> DataStreamReader:
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def _delimited(reader: Reader, schema: T.StructType, sep: str) -> Reader:
    # enforceSchema=False compares every file's header with the schema
    return reader.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False)


def _json_lines(reader: Reader, schema: T.StructType, corrupt_col: str) -> Reader:
    full = T.StructType([*as_text_schema(schema).fields, T.StructField(corrupt_col, T.StringType(), True)])
    return reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
