"""Explicit schemas of the raw feeds and of the four target tables.

Names and types are fixed values: the files and the tables carry them.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _INT, _BIG, _DBL, _DATE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The market metrics in table order; each has a year-over-year
# partner "<name>_yoy" that is always a double.
INT_METRICS = (
    "adjusted_average_new_listings",
    "average_pending_sales_listing_updates",
    "off_market_in_two_weeks",
    "adjusted_average_homes_sold",
    "active_listings",
)
MARKET_METRICS = (
    "adjusted_average_new_listings",
    "average_pending_sales_listing_updates",
    "off_market_in_two_weeks",
    "adjusted_average_homes_sold",
    "median_new_listing_price",
    "median_sale_price",
    "median_days_to_close",
    "median_new_listing_ppsf",
    "active_listings",
    "median_days_on_market",
    "percent_active_listings_with_price_drops",
    "age_of_inventory",
    "months_of_supply",
    "median_pending_sqft",
    "average_sale_to_list_ratio",
    "median_sale_ppsf",
)
_METRIC_FIELDS = tuple(
    field
    for name in MARKET_METRICS
    for field in ((name, _INT if name in INT_METRICS else _DBL), (f"{name}_yoy", _DBL))
)

# --- weekly county market -------------------------------------------------
MARKET_DROPPED = ("region_type", "region_type_id", "region_name", "region_id")
MARKET_KEYS = ("period_begin", "period_end", "county_name", "state_id")

RAW_MARKET = _struct(
    ("period_begin", _DATE),
    ("period_end", _DATE),
    ("region_type", _STR),
    ("region_type_id", _INT),
    ("region_name", _STR),
    ("region_id", _INT),
    ("duration", _STR),
    *_METRIC_FIELDS,
)
MARKET = _struct(
    ("period_begin", _DATE),
    ("period_end", _DATE),
    ("duration", _STR),
    *_METRIC_FIELDS,
    ("county_name", _STR),
    ("state_id", _STR),
    ("processed_date", _DATE),
)

# --- area reference (one row per zip) -------------------------------------
AREA_DROPPED = (
    "zcta",
    "parent_zcta",
    "imprecise",
    "military",
    "timezone",
    "county_weights",
    "county_names_all",
    "county_fips_all",
    "county_fips",
)
AREA_KEYS = ("zip",)

_AREA_FIELDS = (
    ("zip", _INT),
    ("lat", _DBL),
    ("lng", _DBL),
    ("city", _STR),
    ("state_id", _STR),
    ("state_name", _STR),
    ("population", _INT),
    ("density", _DBL),
    ("county_name", _STR),
)
RAW_AREA = _struct(*_AREA_FIELDS, *[(name, _STR) for name in AREA_DROPPED])
AREA = _struct(*_AREA_FIELDS, ("processed_date", _DATE))

# --- places (businesses) ---------------------------------------------------
PLACE_DROPPED = ("attributes", "business_id", "hours", "is_open")
PLACE_KEYS = ("address", "name", "postal_code")

# The dropped fields are left out, so the nested objects are never parsed.
RAW_PLACE = _struct(
    ("address", _STR),
    ("categories", _STR),
    ("city", _STR),
    ("latitude", _DBL),
    ("longitude", _DBL),
    ("name", _STR),
    ("postal_code", _STR),
    ("review_count", _BIG),
    ("stars", _DBL),
    ("state", _STR),
)
PLACE = T.StructType([*RAW_PLACE.fields, *_struct(("processed_date", _DATE), ("zip_int", _INT)).fields])

# --- home value index ------------------------------------------------------
VALUE_KEYS = ("Date", "RegionID", "state_id")
# Fixed value: how the name of a month column starts.
VALUE_COLUMN_PREFIX = "20"

RAW_VALUE_IDS = _struct(
    ("RegionID", _INT),
    ("SizeRank", _INT),
    ("RegionName", _INT),
    ("RegionType", _STR),
    ("StateName", _STR),
    ("State", _STR),
    ("City", _STR),
    ("Metro", _STR),
    ("CountyName", _STR),
)
VALUE = _struct(
    ("RegionID", _INT),
    ("SizeRank", _INT),
    ("RegionName", _INT),
    ("RegionType", _STR),
    ("StateName", _STR),
    ("state_id", _STR),
    ("City", _STR),
    ("Metro", _STR),
    ("county_name", _STR),
    ("Date", _STR),
    ("Value", _DBL),
)
