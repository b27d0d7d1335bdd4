"""Neighbourhood queries over the four tables.

Time series and places are reduced to the grain of the join before they are
joined, so an area is never multiplied by its months or its businesses. No join
carries a broadcast hint: Spark broadcasts a side when its measured size allows
it and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areafacts.functions.measures import latest
from areafacts.operators.dedupe import top_per_group

AREA = ("zip", "state_id")
RESTAURANTS = "Restaurants"

# Shown for a county next to its areas.
MARKET_HEADLINES = ("median_sale_price", "median_days_on_market", "active_listings")


# -- home values --------------------------------------------------------------


def _values_by_zip(values: DataFrame) -> DataFrame:
    """The index with its zip (the region's name, not its surrogate id) and date."""
    return values.withColumn("zip", F.col("RegionName")).withColumn("month", F.col("Date").try_cast("date"))


def latest_value(values: DataFrame) -> DataFrame:
    """The last known home value of each area: ``zip, state_id, value_date, home_value``."""
    known = _values_by_zip(values).where(F.col("Value").isNotNull())
    return known.groupBy(*AREA).agg(
        F.max("month").alias("value_date"), latest(F.col("Value"), F.col("month")).alias("home_value")
    )


def areas_in_price_range(values: DataFrame, lo: float, hi: float) -> DataFrame:
    """Areas whose last known home value lies in the closed range."""
    return latest_value(values).where(F.col("home_value").between(lo, hi))


def value_trend(
    values: DataFrame, by: Sequence[str] = AREA, grain: str = "month", ordered: bool = False
) -> DataFrame:
    """Mean home value per group and period, and its change; ``ordered`` sorts the whole result.

    ``by`` names columns of the index (``zip`` for its region name). ``change``
    is against the group's previous period; the window runs over the aggregated
    rows, at most one per period and group. By area the aggregation reduces next
    to nothing, so the rows are dealt by area first: one shuffle serves the
    aggregation and the window.
    """
    known = _values_by_zip(values).where(F.col("Value").isNotNull())
    if set(AREA) <= set(by):
        known = known.select(*by, "month", "Value").repartition(*by)
    series = (
        known
        .groupBy(*by, F.date_trunc(grain, "month").cast("date").alias("period"))
        .agg(F.avg("Value").alias("mean_value"), F.count("Value").alias("n_values"))
    )
    previous = F.lag("mean_value").over(Window.partitionBy(*by).orderBy("period"))
    trend = series.withColumn("change", F.col("mean_value") - previous)
    return trend.orderBy(*by, "period") if ordered else trend


def value_series(
    values: DataFrame, months_from: str | None = None, months_to: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Home value of every area in every month, gaps closed: ``zip, state_id, month, home_value, known, months_old``.

    A month without a known value carries the last one (``known`` false, ``months_old`` its age); before the first it is
    null. The calendar goes from the first to the last month of the table, or the given ones. Rows are dealt by area once,
    to ``partitions`` tasks (the session's number if none is given), and sorted once; each row then makes the months up to
    its area's next row, so no calendar is joined. Means and gaps are windows over the sorted rows: a hash aggregate by
    month would keep every row of its task, as hardly any two are of one month.
    """
    rows = _values_by_zip(values).where(F.col("month").isNotNull())
    month = F.trunc("month", "month")
    span = values.agg(*[F.trunc(f(F.col("Date").try_cast("date")), "month").alias(n) for n, f in (("a", F.min), ("b", F.max))])
    start = span.select("a").scalar() if months_from is None else F.trunc(F.lit(months_from).cast("date"), "month")
    end = span.select("b").scalar() if months_to is None else F.trunc(F.lit(months_to).cast("date"), "month")
    by_month = Window.partitionBy(*AREA).orderBy("at")
    dealt = rows.select(*AREA, month.alias("at"), "Value")
    dealt = dealt.repartition(*AREA) if partitions is None else dealt.repartition(partitions, *AREA)
    monthly = (
        dealt.withColumn("mean", F.avg("Value").over(Window.partitionBy(*AREA, "at")))
        .withColumn("before", F.lag("at").over(by_month))
        .where(F.col("before").isNull() | (F.col("before") < F.col("at")))
        .select(*AREA, "at", "mean")
    )
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dated = monthly.select(
        *AREA,
        "at",
        F.last("mean", ignorenulls=True).over(so_far).alias("value"),
        F.last(F.when(F.col("mean").isNotNull(), F.col("at")), ignorenulls=True).over(so_far).alias("origin"),
        F.when(F.row_number().over(by_month) == 1, F.least(start, F.col("at"))).otherwise(F.col("at")).alias("first"),
        F.add_months(F.lead("at").over(by_month), -1).alias("before_next"),
    )
    last = F.coalesce("before_next", F.greatest(end, F.col("at")))
    filled = dated.withColumn("month", F.explode(F.sequence("first", last, F.expr("INTERVAL 1 MONTH"))))
    reached = F.col("month") >= F.col("at")
    age = F.months_between("month", "origin").cast("int")
    return filled.where((F.col("month") >= start) & (F.col("month") <= end)).select(
        *AREA,
        "month",
        F.when(reached, F.col("value")).alias("home_value"),
        F.coalesce(reached & (F.col("month") == F.col("origin")), F.lit(False)).alias("known"),
        F.when(reached, age).alias("months_old"),
    )


# -- county market ------------------------------------------------------------


def latest_market(market: DataFrame, metrics: Sequence[str] = MARKET_HEADLINES) -> DataFrame:
    """Metrics of each county's last period."""
    end, begin = F.col("period_end"), F.col("period_begin")
    return market.groupBy("county_name", "state_id").agg(
        F.max("period_end").alias("market_date"), *[latest(F.col(m), end, begin).alias(m) for m in metrics]
    )


def counties_in_price_range(market: DataFrame, lo: float, hi: float, price: str = "median_sale_price") -> DataFrame:
    """Counties whose last median sale price lies in the closed range."""
    return latest_market(market, [price]).where(F.col(price).between(lo, hi))


def market_trend(
    market: DataFrame,
    metrics: Sequence[str] = MARKET_HEADLINES,
    grain: str = "week",
    ordered: bool = False,
    periods_from: str | None = None,
    periods_to: str | None = None,
) -> DataFrame:
    """Market metrics over time per county: as delivered, or the mean per period.

    ``metrics`` may name any of the table's, year-over-year ones included.
    ``periods_from`` and ``periods_to`` (inclusive) bound the begin of the
    delivered periods and reach the scan. ``ordered`` sorts the whole result.
    """
    county = ("county_name", "state_id")
    if periods_from is not None:
        market = market.where(F.col("period_begin") >= F.lit(periods_from).cast("date"))
    if periods_to is not None:
        market = market.where(F.col("period_begin") <= F.lit(periods_to).cast("date"))
    if grain == "week":
        trend = market.select(*county, "period_begin", "period_end", *metrics)
        return trend.orderBy(*county, "period_begin", "period_end") if ordered else trend
    period = F.date_trunc(grain, "period_begin").cast("date").alias("period")
    trend = market.groupBy(*county, period).agg(
        *[F.avg(F.col(m).cast("double")).alias(m) for m in metrics], F.count(F.lit(1)).alias("n_periods")
    )
    return trend.orderBy(*county, "period") if ordered else trend


# -- places ---------------------------------------------------------------------


def has_category(name: str):
    return F.array_contains(F.transform(F.split("categories", ","), lambda c: F.trim(c)), name)


def with_category(places: DataFrame, name: str) -> DataFrame:
    """Places that list ``name`` among their comma-separated categories."""
    return places.where(has_category(name))


def _of_category(places: DataFrame, category: str | None) -> DataFrame:
    return places if category is None else with_category(places, category)


def _place_counts(places: DataFrame) -> DataFrame:
    return places.groupBy(F.col("zip_int").alias("zip"), F.col("state").alias("state_id")).agg(
        F.count(F.lit(1)).alias("places")
    )


def place_density(areas: DataFrame, places: DataFrame, category: str | None = None) -> DataFrame:
    """Places per area and per 1,000 people; an area without any has zero."""
    counts = _place_counts(_of_category(places, category))
    count = F.coalesce("places", F.lit(0).cast("long"))
    return (
        areas.select(*AREA, "population")
        .join(counts, list(AREA), "left")
        .select(
            *AREA,
            "population",
            count.alias("places"),
            F.try_divide(count * F.lit(1000.0), F.col("population")).alias("places_per_1000"),
        )
    )


def _quality_measures() -> list:
    stars, reviews = F.col("stars"), F.col("review_count")
    weight = F.sum(F.when(stars.isNotNull(), reviews))
    return [
        F.avg(stars).alias("mean_stars"),
        F.try_divide(F.sum(stars * reviews), weight).alias("weighted_stars"),
    ]


def place_quality(places: DataFrame, category: str | None = None) -> DataFrame:
    """Mean rating and review-weighted rating of the places of each area."""
    return (
        _of_category(places, category)
        .groupBy(F.col("zip_int").alias("zip"), F.col("state").alias("state_id"))
        .agg(F.count(F.lit(1)).alias("places"), *_quality_measures())
    )


def top_places(
    places: DataFrame, k: int, per: Sequence[str] | None = None, category: str | None = None, slices: int = 1
) -> DataFrame:
    """The ``k`` best places by rating, then reviews; overall or per group.

    Ties are broken by name, address and postal code, which together identify a
    place, so the choice is reproducible.
    """
    order = [F.col("stars").desc(), F.col("review_count").desc(), "name", "address", "postal_code"]
    chosen = _of_category(places, category)
    if per is None:
        return chosen.orderBy(*order).limit(k)
    return top_per_group(chosen, per, order, k, rank="rank", slices=slices)


# -- areas and their neighbourhood ----------------------------------------------


def area_density(areas: DataFrame) -> DataFrame:
    """Population and its density per area, for a map."""
    return areas.select(*AREA, "lat", "lng", "population", "density")


def area_values(areas: DataFrame, values: DataFrame) -> DataFrame:
    """Areas with their last known home value (null if there is none)."""
    return areas.join(latest_value(values), list(AREA), "left")


def place_summary(places: DataFrame, category: str | None = RESTAURANTS) -> DataFrame:
    """Counts and ratings per area, of all places and of one category."""
    in_category = F.lit(True) if category is None else F.coalesce(has_category(category), F.lit(False))
    return (
        places.withColumn("__hit", in_category)
        .groupBy(F.col("zip_int").alias("zip"), F.col("state").alias("state_id"))
        .agg(
            F.count(F.lit(1)).alias("places"),
            F.count_if("__hit").alias("category_places"),
            *_quality_measures(),
            F.avg(F.when(F.col("__hit"), F.col("stars"))).alias("category_stars"),
        )
    )


def area_places(areas: DataFrame, places: DataFrame, category: str | None = RESTAURANTS) -> DataFrame:
    """Areas with the counts and ratings of their places (zero counts if none)."""
    return area_summary(areas, place_summary(places, category))


def area_summary(areas: DataFrame, summary: DataFrame) -> DataFrame:
    """Areas with the row that a summary of places has for them."""
    joined = areas.join(summary, list(AREA), "left")
    per_1000 = F.try_divide(F.col("category_places") * F.lit(1000.0), F.col("population"))
    return joined.fillna(0, ["places", "category_places"]).withColumn("category_per_1000", per_1000)


def area_market(areas: DataFrame, market: DataFrame, metrics: Sequence[str] = MARKET_HEADLINES) -> DataFrame:
    """Areas with the last market figures of their county.

    County names repeat across states, so the join is on both.
    """
    return areas.join(latest_market(market, metrics), ["county_name", "state_id"], "left")


def area_profile(
    areas: DataFrame,
    values: DataFrame,
    market: DataFrame,
    places: DataFrame,
    zip: int | None = None,
    category: str | None = RESTAURANTS,
    metrics: Sequence[str] = MARKET_HEADLINES,
) -> DataFrame:
    """One row per area: home value, places and county market.

    The two joins by (zip, state) come first and share one partitioning of the
    areas. ``zip`` drills down to one area; the filter reaches the scans of the
    value and place tables as well.
    """
    if zip is not None:
        areas = areas.where(F.col("zip") == zip)
    profile = area_places(area_values(areas, values), places, category)
    return area_market(profile, market, metrics).select(
        *AREA,
        "city",
        "county_name",
        "population",
        "density",
        "value_date",
        "home_value",
        "places",
        "category_places",
        "category_per_1000",
        "mean_stars",
        "weighted_stars",
        "category_stars",
        "market_date",
        *metrics,
    )
