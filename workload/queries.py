"""One query per operator, feed and mart, each over whole driver tables.

Dates leave a query as ISO text and lists as comma-joined text, so that a result
compares by value with any other engine's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areafacts import schemas as S
from areafacts import scratch
from areafacts.functions import normalize as N
from areafacts.functions import rules as R
from areafacts.operators import quality, sketches
from areafacts.operators.dedupe import one_per_key, top_per_group
from areafacts.operators.nearest import nearest_labels
from areafacts.operators.reshape import wide_to_long
from areafacts.operators.upsert import upsert
from areafacts.plans import feeds, marts, upkeep
from areafacts.sources import readers, tables
from areafacts.sources.keyed import KeyedTable
from areafacts.streaming import ingest as streams
from workload import frames
from workload.frames import AS_OF, table, twice

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means to six decimals. A sum of doubles depends on the order of addition in its last digits; the hair that is
    added first keeps exact halves from being rounded by them."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), 6) for c in columns})


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf: plain(fn(spark, sf))
    return fn


# -- clean feeds, as the marts read them ----------------------------------------


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.area_reference(frames.raw_area(spark, sf), AS_OF)


def market(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.market_weekly(frames.raw_market(spark, sf), AS_OF)


def places(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.places(frames.raw_place(spark, sf), AS_OF)


def values(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.value_index(frames.raw_value_index(spark, sf))


# Fixed value: rows that one task sorts, or one file of a layout holds.
ROWS_A_TASK = 1_000_000


def _value_tasks(spark: SparkSession, sf: str, least: int) -> int:
    """Tasks for the rows of the value index, which are one per customer and month; footers are read, no rows."""
    rows = frames.table(spark, sf, "customer").count() * len(frames.months(spark, sf))
    return max(least, -(-rows // ROWS_A_TASK))


# -- expressions and rules ---------------------------------------------------------


@query
def county_normalize(spark, sf):
    region = F.concat("n_name", F.lit(" County, "), "r_name")
    county, state = N.split_region(region)
    return frames.customer_regions(spark, sf).select(
        "c_custkey",
        county.alias("county"),
        state.alias("state"),
        N.county(frames.county_label()).alias("plain_county"),
        N.county(F.concat("n_name", F.lit(" Parish")), ("parish", "borough")).alias("parish"),
        N.split_region("n_name")[1].alias("no_state"),
    )


@query
def label_normalize(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", N.label(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment")
    )


@query
def numeric_code(spark, sf):
    number = F.split_part("p_brand", F.lit("#"), F.lit(2))
    coded = table(spark, sf, "part").withColumn(
        "code",
        F.when(F.col("p_type") == "SMALL", F.col("p_brand"))
        .when(F.col("p_type") == "ECONOMY", F.concat(number, F.lit("99999999999")))
        .otherwise(F.lpad(number, 5, "0")),
    )
    kept = coded.where(R.matches("code", R.DIGITS))
    number = N.zip_to_int("code")
    return kept.select("p_partkey", "code", number.alias("number"), N.zip5(number).alias("zip5"))


@query
def cast_double(spark, sf):
    text = F.when(F.col("p_type") == "SMALL", F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf, "part").select("p_partkey", N.to_double(text).alias("price"))


@query
def to_date_any(spark, sf):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.lit("unknown"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", N.to_date_any(text, ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("day")
    )


@query
def conform_types(spark, sf):
    known = F.col("o_orderstatus") != "P"
    text = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(known, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise(F.lit("n/a")).alias("o_totalprice"),
        F.when(known, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.lit("")).alias("day"),
        # whole numbers as some writers give them, and some that are none
        F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_custkey") % 7 == 0, ".5").otherwise(".0")).alias("o_custkey"),
    )
    wanted = T.StructType().add("o_orderkey", "long").add("o_totalprice", "double").add("day", "date")
    wanted = wanted.add("o_custkey", "integer")
    return quality.conform(text, wanted, ["yyyy-MM-dd", "dd.MM.yyyy"])


@query
def stamp_rows(spark, sf):
    return N.stamp(table(spark, sf, "customer").select("c_custkey", "c_name"), AS_OF)


@query
def region_type_filter(spark, sf):
    return quality.keep_region_type(frames.raw_market(spark, sf)).select(
        "period_begin", "region_name", "region_type_id", "active_listings"
    )


@query
def place_rules(spark, sf):
    kept, _ = quality.apply_rules(frames.raw_place(spark, sf), feeds.place_rules())
    return kept.select("address", "name", "stars", "postal_code", "city", "state")


@query
def rejected_rows(spark, sf):
    return feeds.rejected_places(frames.raw_place(spark, sf)).select("address", "reasons")


@query
def quality_report(spark, sf):
    raw = twice(frames.raw_place(spark, sf)).select(*S.RAW_PLACE.names)
    stars = F.when(F.col("review_count") % 10 != 3, F.col("stars").cast("string")).otherwise(F.lit("many"))
    return quality.report(raw.withColumn("stars", stars), S.PLACE_KEYS, feeds.place_rules(), S.RAW_PLACE)


@query
def orphans(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linestatus").alias("status")
    )
    return quality.orphans(orders, lines, ["order_key", "status"])


# -- de-duplication and reshape -----------------------------------------------------


@query
def dedupe_exact(spark, sf):
    return one_per_key(twice(table(spark, sf, "orders")), ["o_orderkey"]).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )


@query
def dedupe_ordered(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = [F.col("l_extendedprice").desc(), "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
    order += ["l_returnflag", "l_linestatus", "l_shipdate"]
    return one_per_key(lines, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


@query
def wide_to_long_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("m_quantity"),
        F.col("l_extendedprice").alias("m_price"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("m_tax"),
    )
    return wide_to_long(lines, "m_", ("measure", "amount"))


# -- feeds ----------------------------------------------------------------------------


@query
def feed_market_weekly(spark, sf):
    return feeds.market_weekly(twice(frames.raw_market(spark, sf)), AS_OF)


@query
def feed_area_reference(spark, sf):
    return feeds.area_reference(twice(frames.raw_area(spark, sf)), AS_OF)


@query
def feed_places(spark, sf):
    raw = frames.raw_place(spark, sf)
    more = raw.withColumn("review_count", F.col("review_count") + 1)
    return feeds.places(raw.union(more), AS_OF, order_by=[F.col("review_count").desc()])


@query
def feed_value_index(spark, sf):
    wide = twice(frames.raw_value_index(spark, sf))
    return feeds.value_index(wide).withColumnRenamed(frames.months(spark, sf)[0][1], "old_month")


@query
def feed_value_index_window(spark, sf):
    wide = frames.raw_value_index(spark, sf)
    names = [name for _, name in frames.months(spark, sf)]
    # two copies of every region that know different months
    copies = [wide.withColumns({c: F.lit(None).cast("double") for c in names[i::2]}) for i in (0, 1)]
    known = copies[0].union(copies[1])
    return feeds.value_index(known, dates_from="2000-06", dates_to="2001-02-28", drop_nulls=True).select(
        "RegionID", "Date", "Value"
    )


# -- upsert and tables ------------------------------------------------------------------


def _stored_orders(spark, sf):
    """Orders up to the end of 1998, as an existing table."""
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    )


def _delivered_orders(spark, sf):
    """Orders from 1998 on with a corrected price, as the next delivery."""
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .select("o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    )


@query
def upsert_basic(spark, sf):
    return upsert(_stored_orders(spark, sf), _delivered_orders(spark, sf), ["o_orderkey"])


def _with_null_status(df):
    return df.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))


@query
def upsert_null_keys(spark, sf):
    target = _with_null_status(_stored_orders(spark, sf))
    source = _with_null_status(_delivered_orders(spark, sf))
    return upsert(target, source, ["o_orderkey", "o_orderstatus"])


@query
def upsert_null_safe(spark, sf):
    target = _with_null_status(_stored_orders(spark, sf))
    source = _with_null_status(_delivered_orders(spark, sf))
    return upsert(target, source, ["o_orderkey", "o_orderstatus"], null_safe=True)


@query
def upsert_evolve(spark, sf):
    source = _delivered_orders(spark, sf).drop("o_custkey").withColumn("source_note", F.lit("second"))
    return upsert(_stored_orders(spark, sf), source, ["o_orderkey"], evolve=True)


@query
def upsert_evolve_added(spark, sf):
    source = _delivered_orders(spark, sf).withColumn("source_note", F.lit("second"))
    return upsert(_stored_orders(spark, sf), source, ["o_orderkey"], evolve=True)


@query
def snapshot_merge(spark, sf):
    """Two deliveries of the market feed merged into a table partitioned by year."""
    store = feeds.FEEDS["market_weekly"].store(spark, scratch.folder(spark, "market"))
    rows = feeds.market_weekly(frames.raw_market(spark, sf), AS_OF)
    split = F.col("period_begin") < F.lit("1999-01-01").cast("date")
    store.merge(rows.where(split))
    later = F.col("period_begin") >= F.lit("1998-01-01").cast("date")
    store.merge(rows.where(later).withColumn("active_listings", F.col("active_listings") + 1000))
    return store.read()


@query
def feed_run(spark, sf):
    """The market feed delivered as tab-separated files, merged, and merged again."""
    home = scratch.folder(spark, "market")
    frames.raw_market(spark, sf).write.option("header", True).option("sep", "\t").csv(f"{home}/in")
    store = feeds.FEEDS["market_weekly"].store(spark, f"{home}/table")
    for _ in range(2):
        feeds.run(spark, "market_weekly", f"{home}/in", store, as_of=AS_OF)
    return store.read()


def _delivered_places(spark, sf, home):
    """The places feed as JSON lines, some broken and some with a mistyped cell."""
    raw = frames.raw_place(spark, sf).withColumn(
        "stars", F.when(F.col("review_count") % 10 != 3, F.col("stars").cast("string")).otherwise(F.lit("many"))
    )
    lines = F.when(F.col("review_count") % 10 != 4, F.to_json(F.struct(*raw.columns)))
    raw.select(F.coalesce(lines, F.concat(F.lit('{"address": '), F.col("address"))).alias("value")).write.text(f"{home}/in")
    return feeds.FEEDS["places"].store(spark, f"{home}/table")


@query
def feed_rejects(spark, sf):
    """What a load of the places feed leaves out: broken lines, mistyped cells, failed rules."""
    home = scratch.folder(spark, "places")
    store = _delivered_places(spark, sf, home)
    feeds.run(spark, "places", f"{home}/in", store, as_of=AS_OF)
    kept = spark.read.parquet(f"{store.root}/rejects/*")
    return kept.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


@query
def feed_counts(spark, sf):
    """What passed by in the same load: its rows, those with a reason, and those of each reason."""
    home = scratch.folder(spark, "places")
    done = feeds.run(spark, "places", f"{home}/in", _delivered_places(spark, sf, home), as_of=AS_OF)
    return spark.createDataFrame(list(done.counts.items()), "what string, n long")


@query
def area_places_upkeep(spark, sf):
    """``area_places`` from sums that followed three deliveries: new places, corrected ones, and places that moved."""
    home, rank = scratch.folder(spark, "upkeep"), F.col("review_count")
    rows = scratch.written(places(spark, sf), "places")[0]
    early = rows.where(rank < 70).withColumns(
        {"stars": F.lit(3.0), "state": F.when(rank % 3 == 0, "elsewhere").otherwise(F.col("state"))}
    )
    base = feeds.FEEDS["places"].store(spark, f"{home}/places")
    mart = upkeep.place_mart()
    state = mart.state(spark, f"{home}/mart", F.floor(F.col("zip") / 1000))
    for name, delivery in (("first", early), ("second", rows.where(rank >= 50)), ("third", rows.where(rank < 60))):
        mart.follow(base, state, delivery, name)
    mart.follow(base, state, rows.where(rank < 60), "third")  # as after a failure
    found = marts.area_summary(areas(spark, sf), mart.read(state)).select(
        "zip", "state_id", "places", "category_places", "category_per_1000", "mean_stars", "weighted_stars"
    )
    return rounded(found, "mean_stars", "weighted_stars")


@query
def named_view(spark, sf):
    tables.register_view(places(spark, sf), "workload_places")
    return spark.sql("SELECT state, count(*) AS places FROM workload_places GROUP BY state")


# -- files --------------------------------------------------------------------------------


@query
def delimited_source(spark, sf):
    path = scratch.folder(spark, "tsv")
    day = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("n/a"))
    (
        table(spark, sf, "orders")
        .select(day.alias("day"), "o_orderkey", "o_totalprice", "o_orderpriority")
        .write.option("header", True)
        .option("sep", "\t")
        .csv(path)
    )
    schema = T.StructType().add("o_orderkey", "long").add("day", "date").add("o_totalprice", "double")
    return readers.read_delimited(spark, path, schema, sep="\t")


@query
def json_source(spark, sf):
    path = scratch.folder(spark, "json")
    events = table(spark, sf, "events")
    whole = F.to_json(F.struct("event_id", "user_id", "event_type", F.create_map(F.lit("a"), F.col("props")).alias("attributes")))
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))
    events.select(F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("value")).write.text(path)
    schema = T.StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string")
    return readers.read_json_lines(spark, path, schema).withColumnRenamed("_corrupt_record", "corrupt")


@query
def wide_source(spark, sf):
    path = scratch.folder(spark, "wide")
    frames.raw_value_index(spark, sf).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    wide = readers.read_wide_index(spark, path, S.RAW_VALUE_IDS)
    return wide_to_long(wide).select("RegionID", "RegionName", "State", "Date", "Value")


# -- marts --------------------------------------------------------------------------------


@query
def latest_value(spark, sf):
    return marts.latest_value(values(spark, sf))


@query
def price_range(spark, sf):
    return marts.areas_in_price_range(values(spark, sf), 100000, 250000)


@query
def county_price_range(spark, sf):
    return marts.counties_in_price_range(market(spark, sf), 400000, 460000)


@query
def value_trend(spark, sf):
    return rounded(marts.value_trend(values(spark, sf)), "mean_value", "change")


@query
def value_trend_county(spark, sf):
    trend = marts.value_trend(values(spark, sf), by=("county_name", "state_id"), grain="quarter")
    return rounded(trend, "mean_value", "change")


@query
def market_trend(spark, sf):
    shown = (*marts.MARKET_HEADLINES, "median_sale_price_yoy", "age_of_inventory")
    return marts.market_trend(market(spark, sf), shown, periods_from="1996-06-01", periods_to="2000-12-31")


@query
def market_trend_month(spark, sf):
    shown = (*marts.MARKET_HEADLINES, "median_sale_price_yoy", "age_of_inventory")
    return rounded(marts.market_trend(market(spark, sf), shown, grain="month"), *shown)


@query
def place_density(spark, sf):
    return marts.place_density(areas(spark, sf), places(spark, sf))


@query
def restaurant_density(spark, sf):
    return marts.place_density(areas(spark, sf), places(spark, sf), marts.RESTAURANTS)


@query
def place_quality(spark, sf):
    return rounded(marts.place_quality(places(spark, sf)), "mean_stars", "weighted_stars")


@query
def category_filter(spark, sf):
    return marts.with_category(places(spark, sf), marts.RESTAURANTS).select("address", "categories", "zip_int")


@query
def top_places(spark, sf):
    return marts.top_places(places(spark, sf), 20).select("address", "name", "stars", "review_count")


@query
def top_places_per_area(spark, sf):
    best = marts.top_places(places(spark, sf), 3, per=("zip_int", "state"), category=marts.RESTAURANTS)
    return best.select("zip_int", "state", "rank", "address", "stars", "review_count")


@query
def top_events(spark, sf):
    """The 1,500 largest events of each type, ranked in slices first."""
    events = table(spark, sf, "events").select("event_type", "event_id", "value")
    return top_per_group(events, ["event_type"], [F.col("value").desc(), "event_id"], 1500, rank="rank", slices=16)


@query
def area_density(spark, sf):
    return marts.area_density(areas(spark, sf))


@query
def area_values(spark, sf):
    return marts.area_values(areas(spark, sf), values(spark, sf)).select(
        "zip", "state_id", "county_name", "value_date", "home_value"
    )


@query
def area_places(spark, sf):
    found = marts.area_places(areas(spark, sf), places(spark, sf)).select(
        "zip", "state_id", "places", "category_places", "category_per_1000", "mean_stars", "weighted_stars"
    )
    return rounded(found, "mean_stars", "weighted_stars")


@query
def area_market(spark, sf):
    return marts.area_market(areas(spark, sf), market(spark, sf)).select(
        "zip", "state_id", "county_name", "market_date", *marts.MARKET_HEADLINES
    )


def _profile(spark, sf, **options):
    found = marts.area_profile(areas(spark, sf), values(spark, sf), market(spark, sf), places(spark, sf), **options)
    return rounded(found, "mean_stars", "weighted_stars", "category_stars")


@query
def area_profile(spark, sf):
    return _profile(spark, sf)


@query
def area_drilldown(spark, sf):
    return _profile(spark, sf, zip=8)


@query
def value_series(spark, sf):
    """Every month of every area, a missing value carried forward."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = marts.value_series(values(spark, sf), partitions=_value_tasks(spark, sf, least))
    return rounded(found, "home_value")


def _bucketed(spark, sf, home):
    """Areas, values and places as tables bucketed by zip and state, as many buckets as the values need."""
    name, buckets = "areafacts_" + home.rsplit("-", 1)[-1], _value_tasks(spark, sf, 16)
    stored = (
        ("areas", areas(spark, sf), ["zip", "state_id"]),
        ("values", values(spark, sf), ["RegionName", "state_id"]),
        ("places", places(spark, sf), ["zip_int", "state"]),
    )
    return [tables.save_bucketed(df, f"{name}_{what}", keys, buckets, f"{home}/{what}") for what, df, keys in stored]


@query
def area_profile_bucketed(spark, sf):
    """The profile from tables that meet without a shuffle."""
    own_areas, own_values, own_places = _bucketed(spark, sf, scratch.folder(spark, "buckets"))
    found = marts.area_profile(own_areas, own_values, market(spark, sf), own_places)
    return rounded(found, "mean_stars", "weighted_stars", "category_stars")


@query
def area_drilldown_clustered(spark, sf):
    """The drill-down into one area from files in ranges of the zip, with Bloom filters."""
    home, files = scratch.folder(spark, "clustered"), _value_tasks(spark, sf, 16)
    stored = {"areas": (areas(spark, sf), "zip"), "values": (values(spark, sf), "RegionName"), "places": (places(spark, sf), "zip_int")}
    for name, (df, zip_column) in stored.items():
        tables.save_clustered(df, f"{home}/{name}", zip_column, files=files, distinct=10_000)
    own = {name: spark.read.schema(df.schema).parquet(f"{home}/{name}") for name, (df, _) in stored.items()}
    found = marts.area_profile(own["areas"], own["values"], market(spark, sf), own["places"], zip=8)
    return rounded(found, "mean_stars", "weighted_stars", "category_stars")


@query
def price_range_clustered(spark, sf):
    """Areas in a price range from their last values stored in ranges of the value."""
    home = scratch.folder(spark, "clustered")
    latest = marts.latest_value(values(spark, sf))
    tables.save_clustered(latest, home, "home_value", files=16)
    return spark.read.schema(latest.schema).parquet(home).where(F.col("home_value").between(100000, 250000))


def _misspelt(spark, sf):
    """County labels as someone typed them: one letter lost, doubled or replaced, or two swapped, for each customer."""
    label, key = F.col("n_name"), F.col("c_custkey")
    at = F.pmod(key, F.length("n_name")).cast("int") + 1
    head, letter, tail = F.substring(label, F.lit(1), at - 1), F.substring(label, at, F.lit(1)), F.substring(label, at + 1, F.length(label))
    typed = (
        F.when(key % 5 == 0, F.concat(head, tail))
        .when(key % 5 == 1, F.concat(head, letter, letter, tail))
        .when(key % 5 == 2, F.concat(head, F.lit("x"), tail))
        .when(key % 5 == 3, F.concat(head, F.substring(tail, 1, 1), letter, F.substring(tail, F.lit(2), F.length(label))))
        .otherwise(F.concat(F.lit("zzz"), label))
    )
    return frames.customer_regions(spark, sf).select(N.label("r_name").alias("state_id"), N.label(typed).alias("county_name"))


@query
def orphan_counties(spark, sf):
    """For each typed county without market figures, the county of its state that was probably meant."""
    known = market(spark, sf).select("county_name", "state_id")
    typed = quality.orphans(_misspelt(spark, sf), known, ["county_name", "state_id"]).where("side = 'left'")
    return nearest_labels(typed, known, "county_name", within=["state_id"])


@query
def quality_sketches(spark, sf):
    """Distinct counts and quantiles over the places of three deliveries, united from the sketches kept of each."""
    home, rows = scratch.folder(spark, "sketches"), frames.raw_place(spark, sf)
    for n, (low, high) in enumerate(((0, 40), (30, 70), (60, 100))):
        part = rows.where((F.col("review_count") >= low) & (F.col("review_count") < high))
        found = sketches.sketch(part, ["address", "city", "categories", "postal_code"], ["stars", "review_count", "latitude"])
        sketches.keep(found, home, f"d{n}")
    return sketches.estimates(sketches.united(sketches.kept(spark, home)))


# -- streams ------------------------------------------------------------------------------

# Successive deliveries of the event stream; the ends are open.
DELIVERIES = (None, "2024-01-08", "2024-01-15", "2024-01-22", None)


def _delivery(spark, sf, lo, hi):
    events = table(spark, sf, "events")
    if lo:
        events = events.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        events = events.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    return events


@query
def stream_ingest(spark, sf):
    """Four deliveries into a drop folder, ingested by one run each."""
    home = scratch.folder(spark, "stream")
    drop, keys = f"{home}/in", ["user_id", "event_type"]
    store = KeyedTable(spark, f"{home}/table", keys)
    schema = frames.SCHEMAS["events"]
    for lo, hi in zip(DELIVERIES, DELIVERIES[1:]):
        _delivery(spark, sf, lo, hi).write.mode("append").parquet(drop)
        streams.ingest(
            spark.readStream.schema(schema).parquet(drop),
            lambda batch: one_per_key(batch, keys, [F.col("ts").desc(), F.col("event_id").desc()]),
            store,
            f"{home}/checkpoint",
        ).awaitTermination()
    return store.read().select("user_id", "event_type", "event_id", "value", "props")


@query
def stream_feed(spark, sf):
    """The places feed as a stream of JSON files, null addresses among them, with the last micro-batch replayed."""
    home = scratch.folder(spark, "places")
    raw = frames.raw_place(spark, sf)
    raw.withColumn("address", F.when(F.col("review_count") % 10 != 5, F.col("address"))).write.json(f"{home}/in")
    store = feeds.FEEDS["places"].store(spark, f"{home}/table")
    for _ in range(2):
        streams.ingest_feed(
            spark, "places", f"{home}/in", f"{home}/in", store, f"{home}/checkpoint", as_of=AS_OF
        ).awaitTermination()
        # as after a failure: the micro-batch is done, the checkpoint does not know
        lost = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/checkpoint/commits")
        lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)
    # places without an address that share name and code are one; which of them is seen by its position alone
    return store.read().drop("latitude", "longitude")


@query
def stream_value_index(spark, sf):
    """Two deliveries of the wide index, the second with more months and other values, in one drop folder."""
    home = scratch.folder(spark, "index")
    wide, names = frames.raw_value_index(spark, sf), [name for _, name in frames.months(spark, sf)]
    early = wide.drop(*names[40:])
    first = early.withColumns({c: F.col(f"`{c}`") + 1 for c in names[1:40]})
    for delivery, name in ((first, "a"), (wide, "b")):
        delivery.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{home}/in/{name}")
    store = feeds.FEEDS["value_index"].store(spark, f"{home}/table")
    streams.ingest_feed(spark, "value_index", f"{home}/in/*", "", store, f"{home}/checkpoint").awaitTermination()
    return store.read().select("RegionID", "state_id", "Date", "Value")


@query
def stream_dedupe(spark, sf):
    """Events delivered again and again, de-duplicated within three days across two runs of one stream.

    The second delivery repeats the last two days before it (dropped: their state is alive) and the first days of the
    month with a later time (new rows: the watermark has passed their state, and it is gone).
    """
    home, cut, day = scratch.folder(spark, "stream"), DELIVERIES[2], F.expr("INTERVAL 1 DAY")
    schema, events = frames.SCHEMAS["events"], table(spark, sf, "events")
    recent = _delivery(spark, sf, None, cut).where(F.col("ts") >= F.lit(cut).cast("timestamp_ntz") - 2 * day)
    old = _delivery(spark, sf, None, "2024-01-05").withColumn("ts", F.col("ts") + 20 * day)
    second = _delivery(spark, sf, cut, None).unionByName(recent).unionByName(old)
    for delivered in (twice(_delivery(spark, sf, None, cut)), second):
        delivered.select(*events.columns).write.mode("append").parquet(f"{home}/in")
        first = streams.dedupe(spark.readStream.schema(schema).parquet(f"{home}/in"), ["event_id"], "ts", "3 days")
        (
            first.select("event_id", "event_type", F.col("ts").cast("date").cast("string").alias("day"))
            .writeStream.option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{home}/out", format="parquet", outputMode="append")
            .awaitTermination()
        )
    return spark.read.schema("event_id bigint, event_type string, day string").parquet(f"{home}/out")
