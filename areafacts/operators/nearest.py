"""The most similar known label for a label without a partner, by edit distance in blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _segments(length: Column, parts: int) -> list[tuple[Column, Column]]:
    """(start from 1, size) of ``parts`` segments of a text: sizes differ by one at most, the longer ones last."""
    size, longer = F.floor(length / parts), length % parts
    found, start = [], F.lit(1)
    for i in range(parts):
        of = size + F.when(F.lit(i) >= parts - longer, 1).otherwise(0)
        found.append((start.cast("int"), of.cast("int")))
        start = start + of
    return found


def _shifted(part: int, start: Column, size: Column, most: int) -> Column:
    """What the text has where a segment may have moved to."""
    length = F.length("text")
    places = F.filter(F.sequence(start - most, start + most), lambda at: (at >= 1) & (at + size <= length + 1))
    return F.transform(places, lambda at: F.struct(F.lit(part).alias("part"), F.substring(F.col("text"), at, size).alias("piece")))


def nearest_labels(
    labels: DataFrame, known: DataFrame, label: str, within: Sequence[str] = (), most: int = 2
) -> DataFrame:
    """``within, label, proposal, distance``: for each label its closest known one, at most ``most`` edits away.

    Both sides are distinct labels within the same ``within`` columns; of equally close ones the first in order is
    proposed, and a label with none close enough has a null. Null labels and ``within`` values have no partner.

    Of two texts at most ``most`` edits apart, one of ``most + 1`` segments of the one is in the other, moved by at most
    as many places. So the pairs that meet share such a segment, its number and a length; the edit distance decides.
    Nothing else is compared, and no pair is lost.
    """
    within = list(within)
    texts = labels.select(*within, label).distinct()
    length, parts = F.length("text"), most + 1
    targets = known.select(*within, F.col(label).alias("text")).distinct().where(F.col("text").isNotNull())
    segments = F.array(
        *[F.struct(F.lit(i).alias("part"), F.substring("text", a, n).alias("piece")) for i, (a, n) in enumerate(_segments(length, parts))]
    )
    targets = targets.select(*within, F.col("text").alias("proposal"), length.alias("size"), F.explode(segments).alias("s"))
    targets = targets.select(*within, "proposal", "size", "s.part", "s.piece")

    sized = texts.where(F.col(label).isNotNull()).select(
        *within, F.col(label).alias("text"), F.explode(F.sequence(F.greatest(F.lit(0), F.length(label) - most), F.length(label) + most)).alias("size")
    )
    pieces = [_shifted(i, a, n, most) for i, (a, n) in enumerate(_segments(F.col("size"), parts))]
    sized = sized.select(*within, "text", "size", F.explode(F.array_distinct(F.flatten(F.array(*pieces)))).alias("s"))
    sized = sized.select(*within, "text", "size", "s.part", "s.piece")

    met = sized.join(targets, [*within, "size", "part", "piece"])
    close = met.withColumn("distance", F.levenshtein("text", "proposal", most)).where(F.col("distance") >= 0)
    best = close.groupBy(*within, "text").agg(F.min(F.struct("distance", "proposal")).alias("best"))
    best = best.select(*within, F.col("text").alias(label), "best.proposal", "best.distance")
    return texts.join(best, [*within, label], "left")
