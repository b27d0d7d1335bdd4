"""Boolean row rules, to be combined into one predicate or a rule table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a postal code is all digits.
DIGITS = r"^\d+$"


def present(name: str) -> Column:
    return F.col(name).isNotNull()


def in_range(name: str, lo: float, hi: float) -> Column:
    """Closed range; null values do not pass."""
    return F.col(name).between(lo, hi)


def matches(name: str, pattern: str) -> Column:
    return F.col(name).rlike(pattern)


def all_of(*rules: Column) -> Column:
    return reduce(lambda a, b: a & b, rules)


def holds(rule: Column) -> Column:
    """Two-valued form of a rule: unknown counts as not satisfied."""
    return F.coalesce(rule, F.lit(False))
