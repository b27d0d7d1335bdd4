"""Keyed de-duplication and top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts.operators.reshape import quoted

ColumnLike = Column | str

# Types an in-place hash aggregate can keep per key.
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnLike] | None = None) -> DataFrame:
    """One row per key; nulls in a key count as equal.

    Without ``order_by`` the survivor is arbitrary. With it the first row in
    that order survives; give a total order to make the result reproducible.
    Either way every task first reduces its own input to one row per key, so
    copies of a hot key do not meet in one task.
    """
    if order_by is None:
        if _fits_hash_aggregate(df, keys):
            return df.dropDuplicates(list(keys))
        order_by = [F.lit(1)]
    return top_per_group(df, keys, order_by, 1)


def _fits_hash_aggregate(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``dropDuplicates`` runs as a hash aggregate.

    It keeps the first value of each further column. One text column turns it
    into a sort with one aggregate per column, which costs several times as much
    as ranking whole rows once a table has hundreds of columns.
    """
    named = {k.lower() for k in keys}
    rest = [f for f in df.schema.fields if f.name.lower() not in named]
    return all(isinstance(f.dataType, _FIXED_WIDTH) for f in rest)


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[ColumnLike],
    k: int,
    rank: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """The first ``k`` rows of each group, optionally with their position.

    Up to the session's group-limit threshold (1,000 rows) Spark itself cuts each map task's groups to ``k`` rows before
    the shuffle; the tasks' cuts of a group then meet in one task. For a larger ``k``, or so many tasks that their cuts
    of one group are too much, ``slices`` deals each group to that many tasks first and ranks within the slices. A row
    among the first ``k`` of its group is among the first ``k`` of its slice, so the result is the same.
    """
    position = rank or "__position"
    if slices > 1:
        # The partition number parts exact copies of a row, which hash alike; unlike a
        # random salt it is the same again when a lost task is repeated.
        salt = F.pmod(F.pmod(content_hash(df), F.lit(slices)) + F.spark_partition_id(), F.lit(slices))
        dealt = df.withColumn("__slice", salt)
        df = _first(dealt, [*group, "__slice"], order_by, k, "__in_slice").drop("__slice", "__in_slice")
    top = _first(df, group, order_by, k, position)
    return top if rank else top.drop(position)


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes the type: it holds no map."""
    if isinstance(kind, T.MapType):
        return False
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, T.StructType) or all(_hashable(f.dataType) for f in kind.fields)


def content_hash(df: DataFrame) -> Column:
    """A number that two rows share if all their columns (but maps) are equal: a tie-break that makes an order total."""
    return F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if _hashable(f.dataType)])


def _first(df: DataFrame, group: Sequence[str], order_by: Sequence[ColumnLike], k: int, position: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)
