"""Wide monthly tables to long rows, and column selection by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areafacts.schemas import VALUE_COLUMN_PREFIX


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def split_columns(names: Sequence[str], prefix: str = VALUE_COLUMN_PREFIX) -> tuple[list[str], list[str]]:
    """(id columns, value columns): a value column's name starts with ``prefix``.

    The rule is by name only, so with the default prefix a ``1999-12-31``
    column stays an id.
    """
    values = [n for n in names if n.startswith(prefix)]
    return [n for n in names if not n.startswith(prefix)], values


def rename_required(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns; a missing one is an error instead of a silent no-op."""
    present = {c.lower() for c in df.columns}
    missing = [old for old in names if old.lower() not in present]
    if missing:
        raise ValueError(f"columns to rename are missing: {missing}")
    return df.withColumnsRenamed(names)


def wide_to_long(
    df: DataFrame,
    value_prefix: str = VALUE_COLUMN_PREFIX,
    names: tuple[str, str] = ("Date", "Value"),
    dates_from: str | None = None,
    dates_to: str | None = None,
    drop_nulls: bool = False,
    as_date: bool = False,
) -> DataFrame:
    """One row per id row and value column: (ids, name as text, value as double).

    A value that is no number is null, and null values are kept unless
    ``drop_nulls`` is set.

    ``dates_from`` and ``dates_to`` (inclusive, compared as text) choose the
    value columns before the unpivot, so the others are not even read: a filter
    on the long rows would come after they have been produced. Narrow: the rows
    multiply inside their task, nothing is shuffled.
    """
    date_name, value_name = names
    ids, values = split_columns(df.columns, value_prefix)
    values = [v for v in values if (dates_from is None or v >= dates_from) and (dates_to is None or v <= dates_to)]
    if not values:
        raise ValueError(f"no value column: none starts with {value_prefix!r} in the given date range")
    long = _unpivot(df, ids, values, date_name, value_name)
    if drop_nulls:
        long = long.where(F.col(value_name).isNotNull())
    if as_date:
        long = long.withColumn(date_name, F.col(date_name).try_cast("date"))
    return long


def _unpivot(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """Spark's unpivot, or one generator over two arrays for very wide tables.

    Unpivot carries a projection per value column. Past the codegen limit (300
    months are usual) it runs interpreted, at half the speed of zipping the
    names with the values.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.codegen.maxFields", "100"))
    kept = [quoted(c) for c in ids]
    numbers = [f"TRY_CAST({quoted(c)} AS DOUBLE)" for c in values]
    if len(ids) + len(values) <= limit:
        typed = df.selectExpr(*kept, *[f"{n} AS {quoted(c)}" for n, c in zip(numbers, values)])
        return typed.unpivot(kept, [quoted(c) for c in values], name, value)
    names = F.expr(f"array({', '.join(map(_literal, values))})").alias(name)
    cells = F.expr(f"array({', '.join(numbers)})").alias(value)
    long = df.select(*kept, F.inline(F.arrays_zip(names, cells)))
    # names are never null; saying so gives both forms the same schema
    return long.withColumn(name, F.coalesce(F.col(quoted(name)), F.lit("")))


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
