"""The same queries as plain SQL over the driver's tables."""

from __future__ import annotations

from workload.frames import FIRST_YEAR, METRICS

def _round(x: str) -> str:
    """Six decimals, a hair up: exact halves round alike whatever the order of addition was."""
    return f"round({x} + 1e-9, 6)"


# -- raw frames -------------------------------------------------------------------

_CUSTOMERS = """
cust AS (
  SELECT c.*, n.n_name, r.r_name,
         n.n_name || CASE c_mktsegment WHEN 'MACHINERY' THEN ' COUNTY' WHEN 'BUILDING' THEN ' county'
                     ELSE ' County' END AS county_label
  FROM customer c JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey
)"""

_MARKET = """
sales AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, o.*, cust.*
  FROM orders o JOIN cust ON o_custkey = c_custkey
),
raw_market AS (
  SELECT week, n_name || ' County, ' || r_name AS region_name, 5 AS region_type_id,
         lower(n_name) AS county_name, lower(r_name) AS state_id,
         CAST(COUNT(*) AS INTEGER) AS n, MAX(o_totalprice) AS high,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, MIN(c_acctbal) AS low
  FROM sales GROUP BY week, n_name, r_name
),
market AS (
  SELECT week AS period_begin, CAST(week + INTERVAL 6 DAY AS DATE) AS period_end, raw_market.*,
         """ + ", ".join(f"{formula} AS {name}" for name, formula in METRICS.items()) + """
  FROM raw_market
)"""

_PLACES = r"""
ev AS (
  SELECT e.*, cust.c_name, cust.r_name, CAST(floor(value * 100) AS BIGINT) % 100 AS k,
         CAST(user_id AS VARCHAR) AS u
  FROM events e JOIN cust ON user_id = c_custkey
),
raw_place AS (
  SELECT CAST(event_id AS VARCHAR) || ' Main St' AS address,
         CASE event_type WHEN 'view' THEN 'Restaurants, Italian' WHEN 'click' THEN 'Shopping, Books'
              WHEN 'purchase' THEN 'Food,  Restaurants ' WHEN 'signup' THEN 'Cafe' END AS categories,
         CASE WHEN event_type <> 'signup' THEN ' ' || c_name ELSE '  ' END AS city,
         value AS latitude, -value AS longitude,
         CASE WHEN event_type <> 'click' OR k >= 5 THEN event_type || '#' || CAST(k AS VARCHAR) END AS name,
         CASE WHEN event_type = 'error' AND k < 50 THEN 'U' || u ELSE lpad(u, 9, '0') END AS postal_code,
         k AS review_count, floor(k / 10.0) * 0.5 + 0.5 AS stars, r_name || ' ' AS state,
         event_type IN ('view', 'purchase') AS restaurant
  FROM ev
),
place AS (
  SELECT address, categories, lower(trim(city)) AS city, latitude, longitude, name, postal_code, review_count,
         CAST(stars AS DOUBLE) AS stars, lower(trim(state)) AS state, '2024-02-01' AS processed_date,
         CAST(postal_code AS INTEGER) AS zip_int, restaurant
  FROM raw_place
  WHERE name IS NOT NULL AND stars BETWEEN 1 AND 5 AND regexp_full_match(postal_code, '[0-9]+')
)"""

_VALUES = f"""
span AS (SELECT MIN(o_orderdate) AS first, MAX(o_orderdate) AS last FROM orders),
months AS (
  SELECT strftime(d, '%Y-%m') AS ym,
         CAST(CAST(last_day(d + to_years({FIRST_YEAR} - CAST(year(first) AS INTEGER))) AS DATE) AS VARCHAR) AS col
  FROM (SELECT first, unnest(generate_series(date_trunc('month', first) + INTERVAL 1 MONTH, last, INTERVAL 1 MONTH)) AS d
        FROM span)
),
monthly AS (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS ym,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders GROUP BY ALL
),
oldest AS (SELECT * FROM monthly WHERE ym = (SELECT strftime(first, '%Y-%m') FROM span)),
cells AS (SELECT cust.*, unnest((SELECT list(ym) FROM months)) AS ym FROM cust),
idx AS (
  SELECT CAST(c_custkey + 1000000 AS INTEGER) AS RegionID, c_nationkey AS SizeRank,
         CAST(c_custkey AS INTEGER) AS RegionName, 'zip' AS RegionType, r_name AS StateName,
         lower(r_name) AS state_id, c_name AS City, c_mktsegment AS Metro, lower(n_name) AS county_name,
         old.total AS old_month, m.col AS "Date", v.total AS "Value"
  FROM cells JOIN months m ON m.ym = cells.ym
  LEFT JOIN monthly v ON v.o_custkey = c_custkey AND v.ym = cells.ym
  LEFT JOIN oldest old ON old.o_custkey = c_custkey
)"""

_AREAS = """
area AS (
  SELECT CAST(c_custkey AS INTEGER) AS zip, c_acctbal / 100 AS lat, c_acctbal / -50 AS lng, c_name AS city,
         lower(r_name) AS state_id, r_name AS state_name, CAST(floor(abs(c_acctbal)) AS INTEGER) AS population,
         c_acctbal AS density, lower(n_name) AS county_name, '2024-02-01' AS processed_date
  FROM cust
)"""

# -- reduced sides of the marts -----------------------------------------------------

_LATEST = """
latest AS (
  SELECT RegionName AS zip, state_id, MAX("Date") AS value_date, arg_max("Value", "Date") AS home_value
  FROM idx WHERE "Value" IS NOT NULL GROUP BY RegionName, state_id
)"""

_SUMMARY = """
summary AS (
  SELECT zip_int AS zip, state AS state_id, COUNT(*) AS places, COUNT(*) FILTER (restaurant) AS category_places,
         """ + _round("AVG(stars)") + """ AS mean_stars,
         """ + _round("SUM(stars * review_count) / NULLIF(CAST(SUM(review_count) AS DOUBLE), 0)") + """ AS weighted_stars,
         """ + _round("AVG(stars) FILTER (restaurant)") + """ AS category_stars
  FROM place GROUP BY zip_int, state
)"""

_LATEST_MARKET = """
latest_market AS (
  SELECT county_name, state_id, CAST(MAX(period_end) AS VARCHAR) AS market_date,
         arg_max(median_sale_price, period_end) AS median_sale_price,
         arg_max(median_days_on_market, period_end) AS median_days_on_market,
         arg_max(active_listings, period_end) AS active_listings
  FROM market GROUP BY county_name, state_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


_PLACE = (_CUSTOMERS, _PLACES)
_INDEX = (_CUSTOMERS, _VALUES)
_PROFILE = _with(_CUSTOMERS, _MARKET, _PLACES, _VALUES, _AREAS, _LATEST, _SUMMARY, _LATEST_MARKET) + """
SELECT a.zip, a.state_id, a.city, a.county_name, a.population, a.density, l.value_date, l.home_value,
       COALESCE(s.places, 0) AS places, COALESCE(s.category_places, 0) AS category_places,
       COALESCE(s.category_places, 0) * 1000.0 / NULLIF(a.population, 0)::DOUBLE AS category_per_1000,
       s.mean_stars, s.weighted_stars, s.category_stars, m.market_date, m.median_sale_price,
       m.median_days_on_market, m.active_listings
FROM area a
LEFT JOIN latest l ON l.zip = a.zip AND l.state_id = a.state_id
LEFT JOIN summary s ON s.zip = a.zip AND s.state_id = a.state_id
LEFT JOIN latest_market m ON m.county_name = a.county_name AND m.state_id = a.state_id
"""

_STORED = "SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_DELIVERED = "SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"


def _order_tables(status: str = "o_orderstatus") -> str:
    return f"WITH t AS ({_STORED.format(status=status)}), s AS ({_DELIVERED.format(status=status)})\n"


_NULL_STATUS = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"

_REJECTED = """
  SELECT address, concat_ws(',',
           CASE WHEN name IS NULL THEN 'name' END,
           CASE WHEN NOT stars BETWEEN 1 AND 5 THEN 'stars' END,
           CASE WHEN NOT regexp_full_match(postal_code, '[0-9]+') THEN 'postal_code' END) AS reasons
  FROM raw_place
"""

_TREND = ("median_sale_price", "median_days_on_market", "active_listings", "median_sale_price_yoy", "age_of_inventory")

_PLACE_COLUMNS = (
    "address",
    "categories",
    "city",
    "latitude",
    "longitude",
    "name",
    "postal_code",
    "review_count",
    "stars",
    "state",
)

_MARKET_ROWS = """
SELECT CAST(period_begin AS VARCHAR) AS period_begin, CAST(period_end AS VARCHAR) AS period_end, '1 weeks' AS duration,
       """ + ", ".join(METRICS) + """, county_name, state_id, '2024-02-01' AS processed_date
FROM market"""

ORACLE: dict[str, str] = {
    "county_normalize": _with(_CUSTOMERS) + """
SELECT c_custkey, lower(n_name) AS county, lower(r_name) AS state,
       lower(trim(regexp_replace(county_label, ' county$', '', 'i'))) AS plain_county,
       lower(n_name) AS parish, CAST(NULL AS VARCHAR) AS no_state
FROM cust""",
    "label_normalize": "SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS segment FROM customer",
    "numeric_code": """
WITH coded AS (
  SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN p_brand
         WHEN 'ECONOMY' THEN split_part(p_brand, '#', 2) || '99999999999'
         ELSE lpad(split_part(p_brand, '#', 2), 5, '0') END AS code
  FROM part
)
SELECT p_partkey, code, TRY_CAST(code AS INTEGER) AS number,
       CASE WHEN length(code) = 5 THEN code END AS zip5
FROM coded WHERE regexp_full_match(code, '[0-9]+')""",
    "cast_double": "SELECT p_partkey, CASE WHEN p_type <> 'SMALL' THEN p_retailprice END AS price FROM part",
    "to_date_any": """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'F') THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
FROM orders""",
    "conform_types": """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
       CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS o_custkey
FROM orders""",
    "stamp_rows": "SELECT c_custkey, c_name, '2024-02-01' AS processed_date FROM customer",
    "region_type_filter": _with(_CUSTOMERS, _MARKET) + """
SELECT CAST(week AS VARCHAR) AS period_begin, region_name, region_type_id, n AS active_listings FROM raw_market""",
    "place_rules": _with(*_PLACE) + """
SELECT address, name, CAST(stars AS DOUBLE) AS stars, postal_code, city, state FROM raw_place
WHERE name IS NOT NULL AND stars >= 1 AND stars <= 5 AND city IS NOT NULL AND state IS NOT NULL
  AND regexp_full_match(postal_code, '[0-9]+')""",
    "rejected_rows": _with(*_PLACE) + f"SELECT * FROM ({_REJECTED}) WHERE reasons <> ''",
    "quality_report": _with(*_PLACE)
    + """, delivered AS (
  SELECT * REPLACE (CASE WHEN review_count % 10 <> 3 THEN stars END AS stars), review_count % 10 = 3 AS misfit
  FROM raw_place
), twice AS (SELECT * FROM delivered UNION ALL SELECT * FROM delivered)
"""
    + "\nUNION ALL\n".join(
        f"SELECT 'null:{c}' AS \"check\", COUNT(*) AS total, "
        f"COUNT(*) FILTER ({c} IS NULL{' AND NOT misfit' if c == 'stars' else ''}) AS failures FROM twice"
        for c in _PLACE_COLUMNS
    )
    + "\nUNION ALL SELECT 'type:stars', COUNT(*), COUNT(*) FILTER (misfit) FROM twice"
    + "".join(
        f"\nUNION ALL SELECT 'rule:{name}', COUNT(*), COUNT(*) FILTER (NOT COALESCE({rule}, FALSE)) FROM twice"
        for name, rule in (
            ("name", "name IS NOT NULL"),
            ("stars", "stars BETWEEN 1 AND 5"),
            ("city", "city IS NOT NULL"),
            ("state", "state IS NOT NULL"),
            ("postal_code", "regexp_full_match(postal_code, '[0-9]+')"),
        )
    )
    + """
UNION ALL SELECT 'duplicate:address,name,postal_code', COUNT(*),
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT address, name, postal_code FROM twice)) FROM twice""",
    "feed_rejects": _with(*_PLACE) + """
SELECT reasons, COUNT(*) AS n FROM (SELECT concat_ws(',',
         CASE WHEN review_count % 10 = 4 THEN 'corrupt' END,
         CASE WHEN review_count % 10 = 3 THEN 'type:stars' END,
         CASE WHEN review_count % 10 <> 4 AND name IS NULL THEN 'rule:name' END,
         CASE WHEN review_count % 10 <> 4 AND (review_count % 10 = 3 OR NOT stars BETWEEN 1 AND 5) THEN 'rule:stars' END,
         CASE WHEN review_count % 10 <> 4 AND NOT regexp_full_match(postal_code, '[0-9]+') THEN 'rule:postal_code' END
       ) AS reasons
FROM raw_place) WHERE reasons <> '' GROUP BY reasons""",
    "feed_counts": _with(*_PLACE) + """
, delivered AS (
  SELECT review_count % 10 = 4 AS corrupt, review_count % 10 = 3 AS misfit, name IS NULL AS no_name,
         review_count % 10 = 3 OR NOT stars BETWEEN 1 AND 5 AS no_stars, NOT regexp_full_match(postal_code, '[0-9]+') AS no_code
  FROM raw_place
), counted AS (
  SELECT COUNT(*) AS "rows", COUNT(*) FILTER (corrupt OR misfit OR no_name OR no_stars OR no_code) AS rejected,
         COUNT(*) FILTER (corrupt) AS corrupt, COUNT(*) FILTER (misfit) AS "type:stars",
         COUNT(*) FILTER (NOT corrupt AND no_name) AS "rule:name", COUNT(*) FILTER (NOT corrupt AND no_stars) AS "rule:stars",
         COUNT(*) FILTER (NOT corrupt AND no_code) AS "rule:postal_code"
  FROM delivered
)
SELECT * FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME what VALUE n) WHERE n > 0""",
    "orphans": """
WITH a AS (SELECT DISTINCT o_orderkey AS order_key, o_orderstatus AS status FROM orders),
     b AS (SELECT DISTINCT l_orderkey AS order_key, l_linestatus AS status FROM lineitem)
SELECT order_key, status, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT order_key, status, 'right' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "dedupe_exact": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       o_orderpriority FROM orders""",
    "dedupe_ordered": """
SELECT * EXCLUDE (l_shipdate, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey,
         l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem
) WHERE rn = 1""",
    "wide_to_long_rows": """
SELECT l_orderkey, l_linenumber, l_partkey, 'm_quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'm_price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'm_tax',
                 CASE WHEN l_returnflag <> 'R' THEN l_tax END FROM lineitem""",
    "feed_market_weekly": _with(_CUSTOMERS, _MARKET) + _MARKET_ROWS,
    "feed_area_reference": _with(_CUSTOMERS, _AREAS) + "SELECT * FROM area",
    "feed_places": _with(*_PLACE) + """
SELECT * EXCLUDE (restaurant) REPLACE (review_count + 1 AS review_count) FROM place""",
    "feed_value_index": _with(*_INDEX) + "SELECT * FROM idx",
    "feed_value_index_window": _with(*_INDEX) + """
SELECT RegionID, "Date", "Value" FROM idx
WHERE "Date" BETWEEN '2000-06' AND '2001-02-28' AND "Value" IS NOT NULL""",
    "upsert_basic": _order_tables() + """
SELECT * FROM s UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "upsert_null_keys": _order_tables(_NULL_STATUS) + """
SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS
  (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey AND s.o_orderstatus = t.o_orderstatus)""",
    "upsert_null_safe": _order_tables(_NULL_STATUS) + """
SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS
  (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey AND s.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus)""",
    "upsert_evolve": _order_tables() + """
SELECT s.o_orderkey, t.o_custkey, s.o_orderstatus, s.o_totalprice, 'second' AS source_note
FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey
UNION ALL
SELECT t.*, NULL FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "upsert_evolve_added": _order_tables() + """
SELECT s.*, 'second' AS source_note FROM s UNION ALL
SELECT t.*, NULL FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "snapshot_merge": _with(_CUSTOMERS, _MARKET) + """
SELECT CAST(period_begin AS VARCHAR) AS period_begin, CAST(period_end AS VARCHAR) AS period_end, '1 weeks' AS duration,
       CASE WHEN period_begin >= DATE '1998-01-01' THEN active_listings + 1000 ELSE active_listings END
         AS active_listings,
       """ + ", ".join(m for m in METRICS if m != "active_listings") + """, county_name, state_id,
       '2024-02-01' AS processed_date
FROM market""",
    "feed_run": _with(_CUSTOMERS, _MARKET) + _MARKET_ROWS,
    "stream_feed": _with(*_PLACE) + """
SELECT * EXCLUDE (restaurant, latitude, longitude) FROM place WHERE review_count % 10 <> 5
UNION ALL
SELECT DISTINCT * EXCLUDE (restaurant, latitude, longitude) REPLACE (CAST(NULL AS VARCHAR) AS address)
FROM place WHERE review_count % 10 = 5""",
    "stream_value_index": _with(*_INDEX) + 'SELECT RegionID, state_id, "Date", "Value" FROM idx',
    "named_view": _with(*_PLACE) + "SELECT state, COUNT(*) AS places FROM place GROUP BY state",
    "delimited_source": """
SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day, o_orderkey,
       o_totalprice, o_orderpriority FROM orders""",
    "json_source": """
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN '{"event_id": ' || CAST(event_id AS VARCHAR) END AS corrupt
FROM events""",
    "wide_source": _with(*_INDEX) + """
SELECT RegionID, RegionName, ' ' || StateName AS "State", "Date", "Value" FROM idx""",
    "latest_value": _with(*_INDEX, _LATEST) + "SELECT * FROM latest",
    "price_range": _with(*_INDEX, _LATEST) + "SELECT * FROM latest WHERE home_value BETWEEN 100000 AND 250000",
    "county_price_range": _with(_CUSTOMERS, _MARKET, _LATEST_MARKET) + """
SELECT county_name, state_id, market_date, median_sale_price FROM latest_market
WHERE median_sale_price BETWEEN 400000 AND 460000""",
    "value_trend": _with(*_INDEX) + f"""
SELECT zip, state_id, CAST(period AS VARCHAR) AS period, {_round("mean_value")} AS mean_value, n_values,
       {_round("mean_value - lag(mean_value) OVER (PARTITION BY zip, state_id ORDER BY period)")} AS change
FROM (SELECT RegionName AS zip, state_id, date_trunc('month', CAST("Date" AS DATE))::DATE AS period,
             AVG("Value") AS mean_value, COUNT("Value") AS n_values
      FROM idx WHERE "Value" IS NOT NULL GROUP BY ALL)""",
    "value_trend_county": _with(*_INDEX) + f"""
SELECT county_name, state_id, CAST(period AS VARCHAR) AS period, {_round("mean_value")} AS mean_value, n_values,
       {_round("mean_value - lag(mean_value) OVER (PARTITION BY county_name, state_id ORDER BY period)")} AS change
FROM (SELECT county_name, state_id, date_trunc('quarter', CAST("Date" AS DATE))::DATE AS period,
             AVG("Value") AS mean_value, COUNT("Value") AS n_values
      FROM idx WHERE "Value" IS NOT NULL GROUP BY ALL)""",
    "market_trend": _with(_CUSTOMERS, _MARKET) + """
SELECT county_name, state_id, CAST(period_begin AS VARCHAR) AS period_begin, CAST(period_end AS VARCHAR) AS period_end,
       median_sale_price, median_days_on_market, active_listings, median_sale_price_yoy, age_of_inventory
FROM market WHERE period_begin BETWEEN DATE '1996-06-01' AND DATE '2000-12-31'""",
    "market_trend_month": _with(_CUSTOMERS, _MARKET) + f"""
SELECT county_name, state_id, CAST(date_trunc('month', period_begin)::DATE AS VARCHAR) AS period,
       {", ".join(f"{_round(f'AVG({m})')} AS {m}" for m in _TREND)}, COUNT(*) AS n_periods
FROM market GROUP BY ALL""",
    "place_density": _with(*_PLACE, _AREAS) + """
SELECT a.zip, a.state_id, a.population, COUNT(p.address) AS places,
       COUNT(p.address) * 1000.0 / NULLIF(a.population, 0)::DOUBLE AS places_per_1000
FROM area a LEFT JOIN place p ON p.zip_int = a.zip AND p.state = a.state_id GROUP BY a.zip, a.state_id, a.population""",
    "restaurant_density": _with(*_PLACE, _AREAS) + """
SELECT a.zip, a.state_id, a.population, COUNT(p.address) AS places,
       COUNT(p.address) * 1000.0 / NULLIF(a.population, 0)::DOUBLE AS places_per_1000
FROM area a LEFT JOIN place p ON p.zip_int = a.zip AND p.state = a.state_id AND p.restaurant
GROUP BY a.zip, a.state_id, a.population""",
    "place_quality": _with(*_PLACE, _SUMMARY) + "SELECT zip, state_id, places, mean_stars, weighted_stars FROM summary",
    "category_filter": _with(*_PLACE) + "SELECT address, categories, zip_int FROM place WHERE restaurant",
    "top_places": _with(*_PLACE) + """
SELECT address, name, stars, review_count FROM place
ORDER BY stars DESC, place.review_count DESC, name, address, postal_code LIMIT 20""",
    "top_places_per_area": _with(*_PLACE) + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY zip_int, state
         ORDER BY stars DESC, review_count DESC, name, address, postal_code) AS rn
  FROM place WHERE restaurant
)
SELECT zip_int, state, CAST(rn AS INTEGER) AS rank, address, stars, review_count FROM ranked WHERE rn <= 3""",
    "top_events": """
SELECT event_type, event_id, value, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events
) WHERE rn <= 1500""",
    "area_density": _with(_CUSTOMERS, _AREAS) + "SELECT zip, state_id, lat, lng, population, density FROM area",
    "area_values": _with(*_INDEX, _AREAS, _LATEST) + """
SELECT a.zip, a.state_id, a.county_name, l.value_date, l.home_value
FROM area a LEFT JOIN latest l ON l.zip = a.zip AND l.state_id = a.state_id""",
    "area_places": _with(*_PLACE, _AREAS, _SUMMARY) + """
SELECT a.zip, a.state_id, COALESCE(places, 0) AS places, COALESCE(category_places, 0) AS category_places,
       COALESCE(category_places, 0) * 1000.0 / NULLIF(a.population, 0)::DOUBLE AS category_per_1000,
       mean_stars, weighted_stars
FROM area a LEFT JOIN summary s ON s.zip = a.zip AND s.state_id = a.state_id""",
    "area_places_upkeep": _with(*_PLACE, _AREAS, _SUMMARY) + """
SELECT a.zip, a.state_id, COALESCE(places, 0) AS places, COALESCE(category_places, 0) AS category_places,
       COALESCE(category_places, 0) * 1000.0 / NULLIF(a.population, 0)::DOUBLE AS category_per_1000,
       mean_stars, weighted_stars
FROM area a LEFT JOIN summary s ON s.zip = a.zip AND s.state_id = a.state_id""",
    "area_market": _with(_CUSTOMERS, _MARKET, _AREAS, _LATEST_MARKET) + """
SELECT a.zip, a.state_id, a.county_name, m.market_date, m.median_sale_price, m.median_days_on_market,
       m.active_listings
FROM area a LEFT JOIN latest_market m ON m.county_name = a.county_name AND m.state_id = a.state_id""",
    "area_profile": _PROFILE,
    "area_drilldown": _PROFILE + "WHERE a.zip = 8",
    "value_series": _with(*_INDEX) + f"""
, dated AS (
  SELECT RegionName AS zip, state_id, date_trunc('month', CAST("Date" AS DATE))::DATE AS month, AVG("Value") AS mean
  FROM idx GROUP BY ALL
), calendar AS (
  SELECT zip, state_id, month FROM (SELECT DISTINCT zip, state_id FROM dated)
  CROSS JOIN (SELECT CAST(unnest(generate_series(MIN(month), MAX(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM dated)
), carried AS (
  SELECT c.*, mean, last_value(mean IGNORE NULLS) OVER w AS home_value,
         last_value(CASE WHEN mean IS NOT NULL THEN c.month END IGNORE NULLS) OVER w AS origin
  FROM calendar c LEFT JOIN dated m USING (zip, state_id, month)
  WINDOW w AS (PARTITION BY c.zip, c.state_id ORDER BY c.month ROWS UNBOUNDED PRECEDING)
)
SELECT zip, state_id, CAST(month AS VARCHAR) AS month, {_round("home_value")} AS home_value, mean IS NOT NULL AS known,
       CAST(date_diff('month', origin, month) AS INTEGER) AS months_old
FROM carried""",
    "area_profile_bucketed": _PROFILE,
    "area_drilldown_clustered": _PROFILE + "WHERE a.zip = 8",
    "price_range_clustered": _with(*_INDEX, _LATEST) + "SELECT * FROM latest WHERE home_value BETWEEN 100000 AND 250000",
    "orphan_counties": _with(_CUSTOMERS, _MARKET) + """
, places AS (SELECT lower(trim(r_name)) AS state_id, n_name AS name, c_custkey AS k, CAST(c_custkey % length(n_name) AS INTEGER) + 1 AS pos FROM cust),
typed AS (
  SELECT DISTINCT state_id, lower(trim(CASE k % 5
    WHEN 0 THEN substr(name, 1, pos - 1) || substr(name, pos + 1)
    WHEN 1 THEN substr(name, 1, pos) || substr(name, pos)
    WHEN 2 THEN substr(name, 1, pos - 1) || 'x' || substr(name, pos + 1)
    WHEN 3 THEN substr(name, 1, pos - 1) || substr(name, pos + 1, 1) || substr(name, pos, 1) || substr(name, pos + 2)
    ELSE 'zzz' || name END)) AS county_name
  FROM places
), known AS (SELECT DISTINCT county_name, state_id FROM market),
lost AS (SELECT * FROM typed WHERE (county_name, state_id) NOT IN (SELECT (county_name, state_id) FROM known)),
ranked AS (
  SELECT l.state_id, l.county_name, k.county_name AS proposal, levenshtein(l.county_name, k.county_name) AS distance,
         row_number() OVER (PARTITION BY l.state_id, l.county_name
           ORDER BY levenshtein(l.county_name, k.county_name), k.county_name) AS n
  FROM lost l JOIN known k ON l.state_id = k.state_id AND levenshtein(l.county_name, k.county_name) <= 2
)
SELECT l.state_id, l.county_name, r.proposal, CAST(r.distance AS INTEGER) AS distance
FROM lost l LEFT JOIN ranked r ON r.state_id = l.state_id AND r.county_name = l.county_name AND r.n = 1""",
    "stream_ingest": """
SELECT user_id, event_type, event_id, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""",
    "stream_dedupe": """
SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
UNION ALL
SELECT event_id, event_type, CAST(CAST(ts + INTERVAL 20 DAY AS DATE) AS VARCHAR) FROM events
WHERE ts < TIMESTAMP '2024-01-05'""",
}
