"""Raw feed frames derived from the driver's tables.

There is no housing data here, so every feed is a projection of whole tables
that grow with the scale factor:

=================  ==========================================================
raw area           one row per customer (zip = customer key, county = nation,
                   state = region)
raw market         orders by week and nation (type 5) and by week and region
                   (type 6)
raw place          one row per event (postal code = user id)
raw value index    orders of a customer by month, months as columns
=================  ==========================================================

``twice`` doubles a frame, so that a feed has exact copies to remove.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areafacts.schemas import INT_METRICS, MARKET_METRICS

AS_OF = "2024-02-01"

# Year of the first month of orders in the wide index. Month columns are shifted to start there, so that their names
# carry the prefix of value columns; the first month keeps its name, which makes it an id column.
FIRST_YEAR = 2000


def months(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    """(month of the orders, name of its column) from the first to the last month of the table."""
    day = F.col("o_orderdate").cast("date")
    first, last = table(spark, sf, "orders").agg(F.min(day), F.max(day)).head()
    found = []
    for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month):
        year, month = divmod(n, 12)
        shown = year + FIRST_YEAR - first.year if found else year
        end = calendar.monthrange(shown, month + 1)[1]
        found.append((f"{year}-{month + 1:02d}", f"{shown}-{month + 1:02d}-{end}"))
    return found


# Schemas of the driver's tables, so that no file is opened to learn them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def twice(df: DataFrame) -> DataFrame:
    return df.union(df)


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def customer_regions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))


def county_label() -> Column:
    segment = F.col("c_mktsegment")
    word = F.when(segment == "MACHINERY", " COUNTY").when(segment == "BUILDING", " county").otherwise(" County")
    return F.concat("n_name", word)


def raw_area(spark: SparkSession, sf: str) -> DataFrame:
    extra = ("zcta", "parent_zcta", "imprecise", "military", "timezone")
    extra += ("county_weights", "county_names_all", "county_fips_all", "county_fips")
    return customer_regions(spark, sf).select(
        F.col("c_custkey").cast("int").alias("zip"),
        (F.col("c_acctbal") / 100).alias("lat"),
        (F.col("c_acctbal") / -50).alias("lng"),
        F.col("c_name").alias("city"),
        F.concat(F.lit(" "), "r_name", F.lit("  ")).alias("state_id"),
        F.col("r_name").alias("state_name"),
        F.floor(F.abs("c_acctbal")).cast("int").alias("population"),
        F.col("c_acctbal").alias("density"),
        county_label().alias("county_name"),
        *[F.col("c_mktsegment").alias(name) for name in extra],
    )


def _metrics() -> dict[str, str]:
    """Every metric column of the market feed as SQL over a week's orders: n, high, total, low."""
    known = {"active_listings": "n", "median_sale_price": "high", "median_new_listing_price": "total", "median_days_on_market": "low"}
    formulas = {}
    for i, name in enumerate(MARKET_METRICS):
        formulas[name] = known.get(name) or (f"n + {i}" if name in INT_METRICS else f"high + {i}")
        formulas[f"{name}_yoy"] = f"(low + {i}) / (high + 1)"
    return formulas


METRICS = _metrics()


def _weekly(df: DataFrame, region_type: int, kind: str, name: Column) -> DataFrame:
    week = F.date_trunc("week", "o_orderdate").cast("date")
    price = money("o_totalprice")
    return (
        df.groupBy(week.alias("period_begin"), name.alias("region_name"))
        .agg(
            F.count(F.lit(1)).cast("int").alias("n"),
            F.max("o_totalprice").alias("high"),
            F.sum(price).cast("double").alias("total"),
            F.min("c_acctbal").alias("low"),
        )
        .select(
            "period_begin",
            F.date_add("period_begin", 6).alias("period_end"),
            F.lit(kind).alias("region_type"),
            F.lit(region_type).alias("region_type_id"),
            "region_name",
            F.lit(0).alias("region_id"),
            F.lit("1 weeks").alias("duration"),
            *[F.expr(formula).alias(name) for name, formula in METRICS.items()],
        )
    )


def raw_market(spark: SparkSession, sf: str) -> DataFrame:
    sales = table(spark, sf, "orders").join(customer_regions(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    by_county = _weekly(sales, 5, "county", F.concat("n_name", F.lit(" County, "), "r_name"))
    by_region = _weekly(sales, 6, "region", F.col("r_name"))
    return by_county.union(by_region)


def raw_place(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    categories = (
        F.when(kind == "view", "Restaurants, Italian")
        .when(kind == "click", "Shopping, Books")
        .when(kind == "purchase", "Food,  Restaurants ")
        .when(kind == "signup", "Cafe")
    )
    k = F.col("k")
    user = F.col("user_id").cast("string")
    # 0.5 to 5.0 in half steps: 0.5 is out of range
    stars = F.floor(k / 10) * 0.5 + 0.5
    return (
        table(spark, sf, "events")
        .withColumn("k", F.floor(F.col("value") * 100) % 100)
        .join(customer_regions(spark, sf), F.col("user_id") == F.col("c_custkey"))
        .select(
            F.concat_ws(" ", F.col("event_id").cast("string"), F.lit("Main St")).alias("address"),
            categories.alias("categories"),
            F.when(kind != "signup", F.concat(F.lit(" "), "c_name")).otherwise(F.lit("  ")).alias("city"),
            F.col("value").alias("latitude"),
            (-F.col("value")).alias("longitude"),
            F.when((kind != "click") | (k >= 5), F.concat(kind, F.lit("#"), k.cast("string"))).alias("name"),
            F.when((kind == "error") & (k < 50), F.concat(F.lit("U"), user)).otherwise(F.lpad(user, 9, "0")).alias("postal_code"),
            k.alias("review_count"),
            stars.alias("stars"),
            F.concat("r_name", F.lit(" ")).alias("state"),
            F.create_map(F.lit("kind"), kind).alias("attributes"),
            F.col("event_id").alias("business_id"),
            F.create_map(F.lit("day"), F.col("ts").cast("string")).alias("hours"),
            F.lit(1).alias("is_open"),
        )
    )


def raw_value_index(spark: SparkSession, sf: str) -> DataFrame:
    """Wide table: ids, the oldest month, which stays an id, and the months after it."""
    columns = months(spark, sf)
    first = columns[0][0]
    since_first = (F.year("o_orderdate") - int(first[:4])) * 12 + F.month("o_orderdate") - int(first[5:])
    # A customer's months meet as a map and become columns after the join: a pivot would keep a buffer of all months for
    # each customer of a task, before its shuffle as well.
    by_month = (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate").isNotNull())
        .groupBy("o_custkey", since_first.alias("month"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("total"))
        .groupBy("o_custkey")
        .agg(F.map_from_entries(F.collect_list(F.struct("month", "total"))).alias("totals"))
    )
    wide = customer_regions(spark, sf).join(by_month, F.col("c_custkey") == F.col("o_custkey"), "left")
    cells = F.transform(F.sequence(F.lit(0), F.lit(len(columns) - 1)), lambda month: F.col("totals")[month])
    wide = wide.withColumn("cells", cells)
    return wide.select(
        (F.col("c_custkey") + 1000000).cast("int").alias("RegionID"),
        F.col("c_nationkey").alias("SizeRank"),
        F.col("c_custkey").cast("int").alias("RegionName"),
        F.lit("zip").alias("RegionType"),
        F.col("r_name").alias("StateName"),
        F.concat(F.lit(" "), "r_name").alias("State"),
        F.col("c_name").alias("City"),
        F.col("c_mktsegment").alias("Metro"),
        county_label().alias("CountyName"),
        *[F.col("cells")[i].alias(name) for i, (_, name) in enumerate(columns)],
    )
