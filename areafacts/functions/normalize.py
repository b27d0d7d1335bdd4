"""Normalising and parsing expressions for place names, codes and dates.

Each function takes a column (or its name) and returns a ``Column``, so a feed
can put all of them into a single projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(c: ColumnLike) -> Column:
    """Lower-cased text without surrounding spaces (other whitespace stays)."""
    return F.lower(F.trim(_col(c)))


def county(c: ColumnLike, suffixes: Sequence[str] = ("county",)) -> Column:
    """County label without its type word: ``"King County"`` -> ``king``.

    The suffix is removed before trimming, so ``"King County "`` keeps it. Other
    area types ("parish", "borough") are opt-in through ``suffixes``.
    """
    words = suffixes[0] if len(suffixes) == 1 else f"({'|'.join(suffixes)})"
    return label(F.regexp_replace(_col(c), f"(?i) {words}$", ""))


def split_region(c: ColumnLike) -> tuple[Column, Column]:
    """``"King County, WA"`` -> county and state columns (``king``, ``wa``).

    A label without a comma has a null state.
    """
    parts = F.split(_col(c), ",")
    return county(F.get(parts, F.lit(0))), label(F.get(parts, F.lit(1)))


def zip_to_int(c: ColumnLike) -> Column:
    """Integer code; text that is no number or does not fit gives null."""
    return _col(c).try_cast("int")


def zip5(c: ColumnLike) -> Column:
    """Five-character display form of an integer code (``501`` -> ``00501``)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def to_double(c: ColumnLike) -> Column:
    """Double; text that is no number gives null."""
    return _col(c).try_cast("double")


def to_date_any(c: ColumnLike, formats: Sequence[str]) -> Column:
    """Date by the first of ``formats`` that parses the text, else null."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)).cast("date") for f in formats])


def as_of_date(as_of: date | str | None) -> Column:
    """The given date, or the date of the run."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def stamp(df: DataFrame, as_of: date | str | None = None, name: str = "processed_date") -> DataFrame:
    """Add the ingest date; pass ``as_of`` to make re-runs reproducible."""
    return df.withColumn(name, as_of_date(as_of))
