"""Row rules, rejected rows, quality counts and keys without a partner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts.functions import rules as R
from areafacts.functions.normalize import to_date_any
from areafacts.operators.reshape import quoted

# Fixed value: region type of a county.
COUNTY_TYPE = 5


def keep_region_type(df: DataFrame, code: int = COUNTY_TYPE, column: str = "region_type_id") -> DataFrame:
    return df.where(F.col(column) == code)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all of ``columns`` are present."""
    return df.where(R.all_of(*[R.present(c) for c in columns]))


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a row is kept if every rule is true; unknown is not true.

    ``rejected`` carries the names of the failed rules in ``reasons``. Both are
    lazy filters over ``df``.
    """
    every = R.all_of(*rules.values())
    reasons = F.array_compact(
        F.array(*[F.when(~R.holds(rule), F.lit(name)) for name, rule in rules.items()])
    )
    kept = df.where(every)
    rejected = df.where(~R.holds(every)).withColumn("reasons", reasons)
    return kept, rejected


def conform(df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = ()) -> DataFrame:
    """Bring the columns ``schema`` names to its types; others stay as they are.

    Text that does not fit is null (see :func:`mistyped`). Whole numbers may be
    written with a fraction of zero (``5.0``). Dates in text are read by the first
    of ``date_formats`` that parses them (ISO if none are given). A fractional
    column is not cut down to integers. Columns that already have their type
    cost nothing.
    """
    changed = _conforming(df, schema, date_formats)
    return df.withColumns(changed) if changed else df


def _conforming(df: DataFrame, schema: T.StructType, date_formats: Sequence[str]) -> dict[str, Column]:
    declared = {f.name.lower(): f.dataType for f in schema.fields}
    changed = {}
    for field in df.schema.fields:
        wanted = declared.get(field.name.lower(), field.dataType)
        fractional = isinstance(field.dataType, T.FractionalType) and isinstance(wanted, T.IntegralType)
        if wanted == field.dataType or fractional:
            continue
        column, from_text = F.col(quoted(field.name)), isinstance(field.dataType, T.StringType)
        if date_formats and isinstance(wanted, T.DateType) and from_text:
            changed[field.name] = to_date_any(column, date_formats)
        elif isinstance(wanted, T.IntegralType) and from_text:
            number = column.try_cast("double")
            whole = F.when(number == F.rint(number), number).try_cast(wanted)
            changed[field.name] = F.coalesce(column.try_cast(wanted), whole)
        else:
            changed[field.name] = column.try_cast(wanted)
    return changed


def mistyped(df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = ()) -> dict[str, Column]:
    """For each column that :func:`conform` would change: whether a cell is there but does not fit its type."""
    changed = _conforming(df, schema, date_formats)
    return {name: F.col(quoted(name)).isNotNull() & typed.isNull() for name, typed in changed.items()}


def report(
    df: DataFrame,
    keys: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None,
    schema: T.StructType | None = None,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """Counts per check: ``check, total, failures``.

    Checks are ``null:<column>`` for every column, ``rule:<name>`` for every
    rule and ``duplicate:<keys>``, the number of rows beyond the first of each
    key. With the ``schema`` that raw rows should have, ``type:<column>`` counts
    the cells that do not fit it; they are not missing, and rules and keys see
    the rows after :func:`conform`. All but the duplicates need one pass that
    sends a single row per task; the keys are counted in a second,
    key-columns-only pass, which keeps the wide counters out of its shuffle.
    """
    names = df.columns
    misfits = mistyped(df, schema, date_formats) if schema else {}
    marks = {c: f"__type{i}" for i, c in enumerate(misfits)}
    if schema:
        df = conform(df.withColumns({marks[c]: misfit for c, misfit in misfits.items()}), schema, date_formats)
    fits = {c: ~F.col(marks[c]) if c in marks else F.lit(True) for c in names}
    checks: dict[str, Column] = {f"null:{c}": F.col(quoted(c)).isNull() & fits[c] for c in names}
    checks.update({f"type:{c}": F.col(mark) for c, mark in marks.items()})
    checks.update({f"rule:{name}": ~R.holds(rule) for name, rule in (rules or {}).items()})
    ids = [f"c{i}" for i in range(len(checks))]
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(check).alias(i) for i, check in zip(ids, checks.values())],
    )
    names = F.create_map(*[F.lit(x) for pair in zip(ids, checks) for x in pair])
    counts = counted.unpivot("total", ids, "id", "failures").select(
        names[F.col("id")].alias("check"), "total", "failures"
    )
    if not keys:
        return counts
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    duplicates = per_key.agg(
        F.lit(f"duplicate:{','.join(keys)}").alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"),
    )
    return counts.unionByName(duplicates)


def orphans(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys present on one side only, with ``side`` left or right.

    A key containing a null has no partner by definition. One grouped pass over
    both sides: each task sends a key once, and neither side is broadcast.
    """
    on = list(on)
    both = left.select(*on, F.lit(True).alias("in_left"), F.lit(False).alias("in_right")).union(
        right.select(*on, F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))
    )
    seen = both.groupBy(*on).agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    matched = F.col("in_left") & F.col("in_right") & R.all_of(*[R.present(c) for c in on])
    sides = F.array_compact(
        F.array(F.when(F.col("in_left"), F.lit("left")), F.when(F.col("in_right"), F.lit("right")))
    )
    return seen.where(~matched).select(*on, F.explode(sides).alias("side"))
