"""Keyed upsert: matched rows are replaced, new rows inserted, others kept."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areafacts.operators.reshape import quoted


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    evolve: bool = False,
) -> DataFrame:
    """The content of ``target`` after merging ``source`` into it.

    * A source row replaces the target row with the same key in all columns;
      without a partner it is inserted. Target-only rows stay. Nothing is deleted.
      The keys of the target are unique; should one repeat, a match leaves it once.
    * A key with a null equals no other key, so such a row is inserted anew by
      every merge. ``null_safe=True`` lets nulls match.
    * The target's column types win. Without ``evolve`` the source must have
      all columns of the target and its extra columns are ignored. With it,
      extra columns are added (null in kept rows) and columns the source lacks
      keep the target's value in matched rows.
    * Two source rows with one key make the job fail when it runs.
    """
    keys = list(keys)
    delivered = _lower(source.columns)
    lacking = [c for c in target.columns if c.lower() not in delivered]
    if lacking and not evolve:
        raise ValueError(f"source lacks columns of the target: {lacking}")
    source = aligned(target, source, evolve)

    if null_safe:
        matchable_target, matchable_source, apart = target, source, []
    else:
        # Rows with a null in the key match nothing: they bypass the join, so
        # they do not pile up in the one task nulls would hash to.
        no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        matchable_target, matchable_source = target.where(no_null), source.where(no_null)
        apart = [target.where(~no_null)]
        if lacking:
            apart.append(source.where(~no_null))

    batch_keys = _checked_keys(matchable_source, keys).where(_once(True)).select(*keys)
    kept = _without(matchable_target, batch_keys, keys, null_safe)
    if lacking:
        replaced = matchable_target.alias("t").join(batch_keys.alias("s"), matching(keys, null_safe), "left_semi")
        parts = [kept, *apart, _filled(matchable_source, replaced.dropDuplicates(keys), keys, target.columns, null_safe)]
    else:
        parts = [kept, *apart, source]
    parts.append(_fail_on_duplicates(matchable_source, keys, parts[0]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _lower(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}


def aligned(target: DataFrame, source: DataFrame, evolve: bool) -> DataFrame:
    """Source columns in target order, names and types; extras last if evolving."""
    delivered, fields = _lower(source.columns), target.schema.fields
    columns = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields if f.name.lower() in delivered]
    if evolve:
        known = _lower(f.name for f in fields)
        columns += [F.col(quoted(c)) for c in source.columns if c.lower() not in known]
    return source.select(*columns)


def _checked_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def _once(outcome: bool) -> Column:
    """``outcome`` for a key that occurs once; raises for any other."""
    text = F.concat(F.lit("duplicate key in the source of an upsert, rows: "), F.col("__n").cast("string"))
    return F.when(F.col("__n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(outcome))


def _fail_on_duplicates(source: DataFrame, keys: list[str], like: DataFrame) -> DataFrame:
    """An always empty branch that raises if a key repeats.

    The join branch holds the same check, but Spark may skip that branch when
    the target is empty. Both use the same key aggregate, so its shuffle is
    planned once and reused.
    """
    empty = _checked_keys(source, keys).where(_once(False))
    return empty.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def matching(keys: list[str], null_safe: bool) -> Column:
    """Condition that the rows ``t`` and ``s`` have one key."""
    pairs = [(F.col(f"t.{quoted(k)}"), F.col(f"s.{quoted(k)}")) for k in keys]
    return reduce(lambda a, b: a & b, [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs])


def _without(target: DataFrame, gone: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    return target.alias("t").join(gone.alias("s"), matching(keys, null_safe), "left_anti")


def _filled(
    source: DataFrame, replaced: DataFrame, keys: list[str], target_columns: list[str], null_safe: bool
) -> DataFrame:
    """Source rows with the columns they lack taken from the target rows they replace.

    Both sides have at most the batch's keys, so the stored table takes no part in this join.
    """
    delivered, known = _lower(source.columns), _lower(target_columns)
    columns = [F.col(f"{'s' if c.lower() in delivered else 't'}.{quoted(c)}").alias(c) for c in target_columns]
    columns += [F.col(f"s.{quoted(c)}").alias(c) for c in source.columns if c.lower() not in known]
    return source.alias("s").join(replaced.alias("t"), matching(keys, null_safe), "left").select(*columns)
