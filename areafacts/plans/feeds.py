"""The four feeds: raw rows to the rows of their keyed table.

Every function is DataFrame to DataFrame and lazy; :func:`run` reads files,
cleans them, merges them into a table and keeps what it had to leave out.

Of several rows with one key the first in ``order_by`` survives, and among equals
the one with the smallest content hash: re-runs choose alike, and rows that are
equal in all columns need no choice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts import schemas as S
from areafacts import scratch
from areafacts.functions import normalize as N
from areafacts.functions import rules as R
from areafacts.operators.dedupe import content_hash, one_per_key
from areafacts.operators.quality import COUNTY_TYPE, apply_rules, conform, keep_region_type, mistyped
from areafacts.operators.reshape import quoted, rename_required, split_columns, wide_to_long
from areafacts.sources import readers
from areafacts.sources.keyed import KeyedTable

AsOf = date | str | None
Order = Sequence[Column | str] | None

_CORRUPT = "_corrupt_record"
# Orders rows as their files arrived.
_ARRIVED = "_arrived"


def _survivors(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    return one_per_key(df, keys, [*(order_by or []), content_hash(df)])


def market_weekly(
    df: DataFrame,
    as_of: AsOf = None,
    region_type: int = COUNTY_TYPE,
    order_by: Order = None,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """County rows of the market feed, one per period, county and state.

    Periods delivered as text become dates, by ``date_formats`` if they are not ISO.
    """
    county, state = N.split_region("region_name")
    cleaned = (
        keep_region_type(conform(df, S.RAW_MARKET, date_formats), region_type)
        .withColumns({"county_name": county, "state_id": state, "processed_date": N.as_of_date(as_of)})
        .drop(*S.MARKET_DROPPED)
    )
    return _survivors(cleaned, S.MARKET_KEYS, order_by)


def area_reference(df: DataFrame, as_of: AsOf = None, order_by: Order = None) -> DataFrame:
    """One row per zip with normalised county and state."""
    cleaned = conform(df, S.RAW_AREA).withColumns(
        {
            "county_name": N.county("county_name"),
            "state_id": N.label("state_id"),
            "processed_date": N.as_of_date(as_of),
        }
    ).drop(*S.AREA_DROPPED)
    return _survivors(cleaned, S.AREA_KEYS, order_by)


# The range of a rating.
MIN_STARS, MAX_STARS = 1, 5


def place_rules() -> dict[str, Column]:
    """Rules a place must pass; city and state are checked after normalising."""
    return {
        "name": R.present("name"),
        "stars": R.in_range("stars", MIN_STARS, MAX_STARS),
        "city": R.present("city"),
        "state": R.present("state"),
        "postal_code": R.matches("postal_code", R.DIGITS),
    }


def _normalised_places(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Places with their types; lines that were no JSON are left out (see :func:`rejects`)."""
    if _CORRUPT in df.columns:
        df = df.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    return conform(df, S.RAW_PLACE).withColumns(
        {"processed_date": N.as_of_date(as_of), "state": N.label("state"), "city": N.label("city")}
    )


def places(df: DataFrame, as_of: AsOf = None, order_by: Order = None) -> DataFrame:
    """Valid places, one per address, name and postal code."""
    kept, _ = apply_rules(_normalised_places(df, as_of), place_rules())
    cleaned = kept.withColumn("zip_int", N.zip_to_int("postal_code")).drop(*S.PLACE_DROPPED)
    return _survivors(cleaned, S.PLACE_KEYS, order_by)


def rejected_places(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The rows :func:`places` leaves out by rule, with the names of the rules."""
    return apply_rules(_normalised_places(df, as_of), place_rules())[1]


def value_index(
    df: DataFrame,
    as_of: AsOf = None,
    order_by: Order = None,
    dates_from: str | None = None,
    dates_to: str | None = None,
    drop_nulls: bool = False,
    value_prefix: str = S.VALUE_COLUMN_PREFIX,
    stamped: bool = False,
) -> DataFrame:
    """Long home value index, one row per region, state and month.

    A wide row holds all months of its region, so one wide row per (region,
    state) is one long row per (region, state, month). De-duplicating before the
    unpivot shuffles each region once instead of once per month. With
    ``drop_nulls`` every month takes its first known value among the region's
    rows. ``stamped`` adds the ingest date, which ``as_of`` only sets.
    """
    one = _one_wide(df, order_by, dates_from, dates_to, drop_nulls, value_prefix)
    long = wide_to_long(one, value_prefix, drop_nulls=drop_nulls)
    return N.stamp(long, as_of) if stamped else long


_REGION_KEYS = [k for k in S.VALUE_KEYS if k != "Date"]


def _one_wide(
    df: DataFrame, order_by: Order, dates_from: str | None, dates_to: str | None, drop_nulls: bool, value_prefix: str
) -> DataFrame:
    """One wide row per region and state."""
    # months nobody wants are neither read nor shuffled, nor do they take part in the choice between rows
    ids, months = split_columns(df.columns, value_prefix)
    months = [m for m in months if (dates_from is None or m >= dates_from) and (dates_to is None or m <= dates_to)]
    df = df.select(*[F.col(quoted(c)) for c in (*ids, *months)])
    named = rename_required(conform(df, S.RAW_VALUE_IDS), {"State": "state_id", "CountyName": "county_name"})
    cleaned = named.withColumns({"state_id": N.label("state_id"), "county_name": N.county("county_name")})
    if drop_nulls:
        return _first_known(cleaned, _REGION_KEYS, order_by, months)
    return _survivors(cleaned, _REGION_KEYS, order_by)


_GROUP, _CELLS, _BEFORE = "__group", "__cells", "__before"


def value_index_groups(
    groups: Sequence[DataFrame],
    as_of: AsOf = None,
    order_by: Order = None,
    dates_from: str | None = None,
    dates_to: str | None = None,
    value_prefix: str = S.VALUE_COLUMN_PREFIX,
    stamped: bool = False,
) -> DataFrame:
    """:func:`value_index` of frames with different months: of a region's rows, the first that has a month gives it.

    The rows of a region meet while they are wide; each is unpivoted past the months of those before it, so no long row
    is shuffled or sorted.
    """
    wide = [_one_wide(group, order_by, dates_from, dates_to, False, value_prefix) for group in groups]
    parts = [split_columns(one.columns, value_prefix) for one in wide]
    months = sorted({m for _, own in parts for m in own})
    if not months:
        raise ValueError(f"no value column: none starts with {value_prefix!r} in the given date range")
    rows = []
    for number, (one, (ids, own)) in enumerate(zip(wide, parts)):
        cells = [F.col(quoted(m)).try_cast("double") if m in own else F.lit(None).cast("double") for m in months]
        extra = [F.lit(number).alias(_GROUP), F.array(*cells).alias(_CELLS)]
        rows.append(one.select(*[F.col(quoted(c)) for c in ids], *extra))
    met = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    ordered = Window.partitionBy(*_REGION_KEYS).orderBy(*(order_by or []), content_hash(met))
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn(_BEFORE, F.collect_list(_GROUP).over(earlier))
    headers = F.array(*[F.array(*[F.lit(months.index(m)) for m in own]).cast("array<int>") for _, own in parts])
    names = F.array(*[F.lit(m) for m in months])
    taken = F.flatten(F.transform(_BEFORE, lambda g: F.get(headers, g)))
    left = F.array_except(F.get(headers, F.col(_GROUP)), taken)
    cells = F.transform(left, lambda i: F.struct(F.get(names, i).alias("Date"), F.get(F.col(_CELLS), i).alias("Value")))
    first = parts[0][0]
    further = [c for c in met.columns if c not in (*first, _GROUP, _CELLS, _BEFORE)]
    long = met.select(*[F.col(quoted(c)) for c in (*first, *further)], F.inline(cells))
    # names are never null, as after an unpivot
    long = long.withColumn("Date", F.coalesce("Date", F.lit("")))
    long = N.stamp(long, as_of) if stamped else long
    added = [c for c in long.columns if c not in (*first, *further)]
    return long.select(*[F.col(quoted(c)) for c in (*first, *added, *further)])


def _first_known(df: DataFrame, keys: Sequence[str], order_by: Order, months: Sequence[str]) -> DataFrame:
    """One row per key with each month's first value that is no null; one shuffle of wide rows."""
    ids = [c for c in df.columns if c not in set(months)]
    ordered = Window.partitionBy(*keys).orderBy(*(order_by or []), content_hash(df))
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = [F.first(F.col(quoted(m)).try_cast("double"), ignorenulls=True).over(whole).alias(m) for m in months]
    rows = df.select(*[F.col(quoted(c)) for c in ids], *known, F.row_number().over(ordered).alias("__n"))
    return rows.where("__n = 1").drop("__n")


@dataclass(frozen=True)
class Feed:
    """How one feed is read, cleaned, keyed and laid out.

    ``read`` gives the raw rows of files as text, with ``_arrived``, in one frame
    for each header. ``stream`` takes the drop folder, a file with the layout of its
    files and the number of files per micro-batch, and ``groups`` makes of a
    micro-batch what ``read`` gives. ``rules`` are checked on ``prepare``d rows.
    ``clean_groups`` cleans frames with different headers together, where that can
    be had for less than cleaning each and choosing between the rows.
    """

    name: str
    schema: Callable[[list[str]], T.StructType]
    read: Callable[[SparkSession, str], list[DataFrame]]
    stream: Callable[[SparkSession, str, str, int | None], DataFrame]
    clean: Callable[..., DataFrame]
    keys: tuple[str, ...]
    partition_by: Callable[[], Column]
    groups: Callable[[DataFrame], list[DataFrame]] = lambda batch: [batch]
    prepare: Callable[[DataFrame], DataFrame] | None = None
    rules: Callable[[], dict[str, Column]] = dict
    clean_groups: Callable[..., DataFrame] | None = None

    def store(self, spark: SparkSession, root: str, partition_by: Column | None = None) -> KeyedTable:
        """The feed's table; a finer ``partition_by`` suits larger tables."""
        return KeyedTable(spark, root, self.keys, self.partition_by() if partition_by is None else partition_by)


def _with_arrival(df: DataFrame) -> DataFrame:
    return df.withColumn(_ARRIVED, readers.arrival())


# Partitions are functions of the key: a merge reads and writes those its batch touches.
FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "market_weekly",
            lambda names: S.RAW_MARKET,
            lambda spark, path: [_with_arrival(readers.read_delimited(spark, path, S.RAW_MARKET, "\t", as_text=True))],
            lambda spark, folder, like, n: _with_arrival(
                readers.stream_delimited(spark, folder, like, S.RAW_MARKET, "\t", n)
            ),
            market_weekly,
            S.MARKET_KEYS,
            lambda: F.year("period_begin"),
        ),
        Feed(
            "area_reference",
            lambda names: S.RAW_AREA,
            lambda spark, path: [_with_arrival(readers.read_delimited(spark, path, S.RAW_AREA, as_text=True))],
            lambda spark, folder, like, n: _with_arrival(
                readers.stream_delimited(spark, folder, like, S.RAW_AREA, ",", n)
            ),
            area_reference,
            S.AREA_KEYS,
            lambda: F.floor(F.col("zip") / 1000),
        ),
        Feed(
            "places",
            lambda names: S.RAW_PLACE,
            lambda spark, path: [_with_arrival(readers.read_json_lines(spark, path, S.RAW_PLACE, _CORRUPT, as_text=True))],
            lambda spark, folder, like, n: _with_arrival(
                readers.stream_json_lines(spark, folder, S.RAW_PLACE, _CORRUPT, n)
            ),
            places,
            S.PLACE_KEYS,
            lambda: F.substring("postal_code", 1, 3),
            prepare=_normalised_places,
            rules=place_rules,
        ),
        Feed(
            "value_index",
            lambda names: readers.wide_schema(names, S.RAW_VALUE_IDS),
            lambda spark, path: readers.wide_groups(spark, readers.files_under(spark, path), _ARRIVED),
            lambda spark, folder, like, n: readers.stream_files(spark, folder, n),
            value_index,
            S.VALUE_KEYS,
            lambda: F.substring("Date", 1, 4),
            groups=lambda batch: readers.wide_groups(batch.sparkSession, batch, _ARRIVED),
            clean_groups=value_index_groups,
        ),
    )
}


def cleaned(feed: Feed, groups: Sequence[DataFrame], **options) -> DataFrame:
    """One row per key of raw rows that may have several headers; of one key, the row that arrived last.

    Groups with different headers are cleaned apart (a wide table's months are rows by then) and put together, just as
    if their files had been merged one after the other.
    """
    latest = [F.col(_ARRIVED).desc()]
    # with drop_nulls a month's first known value counts, which the header does not tell
    if feed.clean_groups is not None and len(groups) > 1 and not options.get("drop_nulls"):
        return feed.clean_groups(groups, order_by=latest, **{k: v for k, v in options.items() if k != "drop_nulls"}).drop(_ARRIVED)
    parts = [feed.clean(group, order_by=latest, **options) for group in groups]
    if len(parts) == 1:
        return parts[0].drop(_ARRIVED)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _survivors(rows, feed.keys, latest).drop(_ARRIVED)


_ROW, _REASONS, _REJECTED = "__row", "__reasons", "__rejected"
_CORRUPT_LINE = "corrupt"


def reasons(feed: Feed, names: Sequence[str], misfits: Sequence[str]) -> list[str]:
    """Every reason a row of the feed can have: ``corrupt`` (a line that is no record), ``type:<column>`` (a cell that is
    there and does not fit: null in the table) and ``rule:<name>`` (the row is not in the table)."""
    corrupt = [_CORRUPT_LINE] if _CORRUPT in names else []
    return [*corrupt, *[f"type:{c}" for c in misfits], *[f"rule:{name}" for name in feed.rules()]]


def marked(feed: Feed, raw: DataFrame, date_formats: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``raw`` rows, prepared, with their reasons and, where there are any, the raw row as JSON; and all reasons there can be.

    Rows of another region type are no rejects.
    """
    names = [c for c in raw.columns if c != _ARRIVED]
    misfits = mistyped(raw, feed.schema(names), date_formats)
    corrupt = F.col(_CORRUPT).isNotNull() if _CORRUPT in names else F.lit(False)
    found = [F.when(corrupt, F.lit(_CORRUPT_LINE)), *[F.when(m, F.lit(f"type:{c}")) for c, m in misfits.items()]]
    cells = F.struct(*[F.col(quoted(c)) for c in names])
    rows = raw.withColumns({_ROW: cells, _REASONS: F.array_compact(F.array(*found))})
    if feed.prepare is not None:
        if _CORRUPT in names:
            rows = rows.withColumn(_CORRUPT, F.lit(None).cast("string"))  # corrupt lines stay until they are reported
        rows = feed.prepare(rows)
        broken = [F.when(~R.holds(rule), F.lit(f"rule:{name}")) for name, rule in feed.rules().items()]
        is_corrupt = F.array_contains(_REASONS, _CORRUPT_LINE)
        broken = F.when(~is_corrupt, F.array_compact(F.array(*broken))).otherwise(F.array().cast("array<string>"))
        rows = rows.withColumn(_REASONS, F.concat(_REASONS, broken))
    text = F.to_json(_ROW)
    if _CORRUPT in names:
        text = F.coalesce(F.col(f"{_ROW}.{_CORRUPT}"), text)
    return rows.withColumn(_ROW, F.when(F.size(_REASONS) > 0, text)), reasons(feed, names, list(misfits))


def rejects(feed: Feed, raw: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """What a load leaves out or empties: ``feed, reasons, row`` (the raw row as JSON)."""
    return _rejected(feed, marked(feed, raw, date_formats)[0])


def _rejected(feed: Feed, rows: DataFrame) -> DataFrame:
    return rows.where(F.size(_REASONS) > 0).select(
        F.lit(feed.name).alias("feed"), F.col(_REASONS).alias("reasons"), F.col(_ROW).alias("row")
    )


@dataclass(frozen=True)
class Parsed:
    """A delivery of one header, parsed once: its rows, its rejects, rows per reason, and where they are stored."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    path: str


def parse(feed: Feed, raw: DataFrame, date_formats: Sequence[str] = ()) -> Parsed:
    """Read the raw rows once: one write puts rows with and without reasons apart, and counts them as they pass."""
    rows, possible = marked(feed, raw, date_formats)
    passing = Observation()
    counts = [F.count_if(F.array_contains(_REASONS, reason)).alias(reason) for reason in possible]
    observed = rows.observe(passing, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(_REASONS) > 0).alias("rejected"), *counts)
    path = scratch.folder(raw.sparkSession, "parsed")
    observed.withColumn(_REJECTED, F.size(_REASONS) > 0).write.partitionBy(_REJECTED).parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField(_REJECTED, T.BooleanType())])
    stored = raw.sparkSession.read.schema(schema).parquet(path)
    whole = stored.where(~F.array_contains(_REASONS, _CORRUPT_LINE)).drop(_ROW, _REASONS, _REJECTED)
    return Parsed(whole, _rejected(feed, stored.where(_REJECTED)), {k: v for k, v in passing.get.items() if v}, path)


@dataclass(frozen=True)
class Load:
    """What a load did: the partitions it wrote, and its rows, in all, rejected, and by reason."""

    partitions: list[str]
    counts: dict[str, int]


def load(feed: Feed, groups: Sequence[DataFrame], table: KeyedTable, name: str, batch: str | None = None, **options) -> Load:
    """Parse raw rows (a frame for each header), merge them into ``table`` and keep their rejects under its root.

    Rejects go to ``rejects/<name>``; a load of the same name overwrites its own. ``options`` go to the cleaning function.
    """
    parsed = [parse(feed, group, options.get("date_formats", ())) for group in groups]
    try:
        written = table.merge(cleaned(feed, [p.rows for p in parsed], **options), batch=batch)
        reduce(DataFrame.union, [p.rejects for p in parsed]).write.mode("overwrite").parquet(f"{table.root}/rejects/{name}")
    finally:
        scratch.remove(table.spark, *[p.path for p in parsed])
    counts = {reason: sum(p.counts.get(reason, 0) for p in parsed) for p in parsed for reason in p.counts}
    return Load(written, counts)


def run(spark: SparkSession, feed: str | Feed, path: str, store: KeyedTable, as_of: AsOf = None, **options) -> Load:
    """Read ``path`` once, clean it and merge it into ``store``.

    A re-run of the same files replaces their rows and adds none (but for keys with a null, which match nothing), and
    overwrites their rejects.
    """
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    name = hashlib.sha256(path.encode()).hexdigest()[:16]
    return load(spec, spec.read(spark, path), store, name, as_of=as_of, **options)
