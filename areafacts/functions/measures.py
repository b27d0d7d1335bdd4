"""Aggregate expressions of the marts."""


from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest(value: Column, *days: Column) -> Column:
    """``value`` of the row with the greatest ``days`` (one or two dates, the
    first decides, a null date counts as the earliest).

    The dates are packed into one long: a long fits the hash-aggregate buffer,
    an ordering struct would turn the aggregate into a sort.
    """
    if not 1 <= len(days) <= 2:
        raise ValueError("one or two ordering dates")
    order = F.lit(0).cast("long")
    for day in days:
        # day number + 2^20 lies in [0, 2^22) for every date of the years 1 to 9999
        number = F.coalesce(F.unix_date(day).cast("long") + F.lit(1 << 20), F.lit(0))
        order = order * F.lit(1 << 22) + number
    return F.max_by(value, order)
