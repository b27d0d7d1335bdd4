"""What a merge changes, and aggregates that take changes back as well as add them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areafacts.operators.reshape import quoted
from areafacts.operators.upsert import aligned, matching

SIGN = "sign"
# Rows behind a group's state, and the delivery that last changed it.
ROWS, DELIVERY = "n_rows", "delivery"
# Sums are decimals: what is taken back leaves nothing behind, as it would of a sum of doubles.
_EXACT = "decimal(28,6)"


def changes(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows that a merge of ``source`` into ``target`` takes away (``sign`` -1) and adds (+1), in the target's columns.

    A source row that equals the one it replaces is no change; one with a null in its key is added (unless ``null_safe``).
    The target is read past the batch's keys; only the rows they replace are joined.
    """
    source = aligned(target, source, evolve=False)
    columns = target.columns
    on = matching(list(keys), null_safe)
    replaced = target.alias("t").join(source.select(*keys).alias("s"), on, "left_semi")
    old, new = (F.struct(*[F.col(f"{side}.{quoted(c)}").alias(c) for c in columns]) for side in "ts")
    pairs = (
        source.alias("s")
        .join(replaced.withColumn("__there", F.lit(True)).alias("t"), on, "left")
        .select(F.when(F.col("__there"), old).alias("old"), new.alias("new"))
        .where(~F.col("old").eqNullSafe(F.col("new")))
    )
    both = F.array(F.struct(F.lit(-1).alias(SIGN), F.col("old").alias("row")), F.struct(F.lit(1).alias(SIGN), F.col("new").alias("row")))
    rows = pairs.select(F.explode(both).alias("c")).where(F.col("c.row").isNotNull())
    return rows.select(f"c.{SIGN}", *[F.col(f"c.row.{quoted(c)}").alias(c) for c in columns])


@dataclass(frozen=True)
class Sum:
    """A sum to keep, and the number of its values that are not null."""

    name: str
    value: Column

    @property
    def columns(self) -> tuple[str, str]:
        return f"{self.name}_sum", f"{self.name}_n"

    @property
    def mean(self) -> Column:
        total, n = (F.col(c).cast("double") for c in self.columns)
        return F.try_divide(total, n)


def partials(signed: DataFrame, by: dict[str, Column], sums: Sequence[Sum]) -> DataFrame:
    """Per group, what signed rows add to its state; each task adds up its own first."""
    sign, found = F.col(SIGN), [F.sum(SIGN).alias(ROWS)]
    for s in sums:
        value = s.value.cast(_EXACT)
        total, n = s.columns
        found.append(F.coalesce(F.sum(F.when(sign < 0, -value).otherwise(value)), F.lit(0)).cast("decimal(38,6)").alias(total))
        found.append(F.coalesce(F.sum(F.when(value.isNotNull(), sign)), F.lit(0).cast("long")).alias(n))
    return signed.groupBy(*[c.alias(name) for name, c in by.items()]).agg(*found)


def advanced(state: DataFrame, delta: DataFrame, by: Sequence[str], delivery: str) -> DataFrame:
    """The states of the groups in ``delta``, after it. A group that had this ``delivery`` already stays as it is, and is left out."""
    added = [c for c in delta.columns if c not in by]
    on = matching(list(by), null_safe=True)
    known = state.alias("t").join(delta.select(*by).alias("s"), on, "left_semi")
    again = F.col(f"t.{DELIVERY}").eqNullSafe(F.lit(delivery))
    new = [(F.coalesce(F.col(f"t.{c}"), F.lit(0)) + F.col(f"s.{c}")).cast(delta.schema[c].dataType).alias(c) for c in added]
    joined = delta.alias("s").join(known.alias("t"), on, "left").where(~again)
    return joined.select(*[F.col(f"s.{c}").alias(c) for c in by], *new, F.lit(delivery).alias(DELIVERY))
