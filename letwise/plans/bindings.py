"""Stand-in inputs built from the test tables.

The test tables hold no listings, so each binding renames and re-labels test columns
into the listing schema (text labels, categories, type names, dates). A binding only
produces rows in the shape the job expects; it does none of the job's work. Each
Spark builder has a SQL twin (a CTE body for DuckDB) next to it so both sides of the
correctness check start from the same rows.

Value maps below relabel test-table domains into the listing domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise.sources.files import read_table

# Test-domain -> listing-domain relabelling (binding choices, not fixed by the source).
SEGMENT_CATEGORY = {
    "AUTOMOBILE": "Apartment / Condominium",
    "BUILDING": "Commercial Property",
    "FURNITURE": "House",
    "HOUSEHOLD": "Room",
    "MACHINERY": "Land",
}
PRIORITY_CATEGORY = {
    "1-URGENT": "Commercial Property",
    "2-HIGH": "Room",
    "3-MEDIUM": None,
    "4-NOT SPECIFIED": "Apartment / Condominium",
    "5-LOW": "Land",
}
PTYPE_NAME = {
    "ECONOMY": "Condominium",
    "LARGE": "Bungalow House",
    "MEDIUM": "2-storey Terraced House",
    "PROMO": " Service Residence ",
    "SMALL": "Studio",
    "STANDARD": "Penthouse",
}
PTYPE_CATEGORY = {
    "ECONOMY": "Apartment / Condominium",
    "LARGE": "House",
    "MEDIUM": "Room",
    "PROMO": "Commercial Property",
    "SMALL": "Land",
    "STANDARD": "Apartment / Condominium",
}
# customer key % 7 -> property type name (None = missing)
CUSTOMER_TYPES = ["Condominium", "Service Residence", "Flat", "Studio", "Terraced House", "Penthouse", None]


def case_col(col: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        val = F.lit(v).cast("string")
        out = F.when(col == k, val) if out is None else out.when(col == k, val)
    return out


def case_sql(expr: str, mapping: dict) -> str:
    parts = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {parts} END)"


def index_col(idx: Column, values: list) -> Column:
    return case_col(idx, {i: v for i, v in enumerate(values)})


def index_sql(expr: str, values: list) -> str:
    parts = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {expr} {parts} END)"


def _q(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def money_label(x: Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("RM "), F.format_number(x, decimals), F.lit(" per month"))


def money_label_sql(x: str) -> str:
    return f"('RM ' || format('{{:,.2f}}', {x}) || ' per month')"


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


# --------------------------------------------------------------------------- customers
def customer_listings(spark: SparkSession, d: str) -> DataFrame:
    """Customers as raw listings: rent label from the balance, category from the segment,
    state = region name, region = nation name, a type name from the key."""
    c = T(spark, d, "customer")
    n = T(spark, d, "nation")
    r = T(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    return j.select(
        k.cast("string").alias("ads_id"),
        money_label(F.col("c_acctbal")).alias("monthly_rent"),
        F.concat(case_col(F.col("c_mktsegment"), SEGMENT_CATEGORY), F.lit(", For rent")).alias("category_id"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("region"),
        index_col(k % 7, CUSTOMER_TYPES).alias("property_type"),
        F.col("c_mktsegment"),
        k.alias("c_custkey"),
    )


def customer_listings_sql() -> str:
    return f"""
    SELECT CAST(c_custkey AS VARCHAR) AS ads_id,
           {money_label_sql('c_acctbal')} AS monthly_rent,
           {case_sql('c_mktsegment', SEGMENT_CATEGORY)} || ', For rent' AS category_id,
           r_name AS state, n_name AS region,
           {index_sql('c_custkey % 7', CUSTOMER_TYPES)} AS property_type,
           c_mktsegment, c_custkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


# --------------------------------------------------------------------------- parts
def part_listings(spark: SparkSession, d: str) -> DataFrame:
    """Parts as raw listings: rent from the retail price, raw type name from ``p_type``
    (missing for every 9th key)."""
    p = T(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(
        k.cast("string").alias("ads_id"),
        money_label(F.col("p_retailprice")).alias("monthly_rent"),
        F.when(k % 9 != 0, case_col(F.col("p_type"), PTYPE_NAME)).alias("property_type"),
        F.col("p_partkey"),
    )


def part_listings_sql() -> str:
    return f"""
    SELECT CAST(p_partkey AS VARCHAR) AS ads_id,
           {money_label_sql('p_retailprice')} AS monthly_rent,
           CASE WHEN p_partkey % 9 <> 0 THEN {case_sql('p_type', PTYPE_NAME)} END AS property_type,
           p_partkey
    FROM part"""


# --------------------------------------------------------------------------- orders
def order_table(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a typed listing table with availability columns.

    first_seen = order date; last_checked_at = last ship date of the order (never checked
    when it has no lines); every 37th listing is already rented."""
    o = T(spark, d, "orders")
    li = T(spark, d, "lineitem")
    last = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last_ship"), F.count(F.lit(1)).alias("_n_lines"))
    j = o.join(last, o.o_orderkey == last.l_orderkey, "left")
    k = F.col("o_orderkey")
    rented = k % 37 == 0
    return j.select(
        k.cast("string").alias("ads_id"),
        F.col("o_orderpriority").alias("state"),
        F.to_date("o_orderdate").alias("first_seen"),
        F.to_date("_last_ship").alias("last_checked_at"),
        F.when(rented, F.lit("rented")).otherwise(F.lit("active")).alias("availability_status"),
        F.when(rented, F.to_date(F.lit("2001-01-01"))).alias("gone_at"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 39 DAYS"), "yyyy-MM-dd HH:mm:ss").alias("ad_expiry"),
        F.coalesce(F.col("_n_lines"), F.lit(0)).alias("_n_lines"),
        F.col("o_orderdate").alias("_orderdate"),
    )


def order_table_sql() -> str:
    return """
    SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderpriority AS state,
           CAST(o_orderdate AS DATE) AS first_seen, CAST(l.last_ship AS DATE) AS last_checked_at,
           CASE WHEN o_orderkey % 37 = 0 THEN 'rented' ELSE 'active' END AS availability_status,
           CASE WHEN o_orderkey % 37 = 0 THEN DATE '2001-01-01' END AS gone_at,
           strftime(o_orderdate + INTERVAL 39 DAY, '%Y-%m-%d %H:%M:%S') AS ad_expiry,
           coalesce(l.n_lines, 0) AS n_lines, o_orderkey, o_orderdate
    FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_lines
                           FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l.l_orderkey"""


def order_probe_log(spark: SparkSession, d: str) -> DataFrame:
    """Probe log for the order listings: an older probe that saw every listing alive, and
    the latest probe: failed for every 50th key, else the number of lines as items."""
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    lines = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = o.join(lines, o.k == lines.l_orderkey, "left")
    probe = lambda at, ok, n: F.struct(F.lit(at).cast("timestamp").alias("checked_at"), ok.alias("http_ok"),
                                       n.cast("bigint").alias("n_items"))
    both = F.array(probe("2001-07-14 09:00:00", F.lit(True), F.lit(1)),
                   probe("2001-07-15 09:00:00", F.col("k") % 50 != 0, F.coalesce(F.col("n"), F.lit(0))))
    return j.select(F.col("k").cast("string").alias("ads_id"), F.explode(both).alias("p")).select("ads_id", "p.*")


def order_text_table(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a re-check input with text dates, as stored by older tables: first_seen
    is the order timestamp text (10-char prefix counts), some values are garbage."""
    t = order_table(spark, d)
    k = F.col("ads_id").cast("bigint")
    return t.select(
        "ads_id",
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .when(k % 29 == 0, F.lit("garbage"))
         .otherwise(F.col("_orderdate").cast("string")).alias("first_seen"),
        F.when(k % 97 == 0, F.lit("garbage"))
         .otherwise(F.date_format("last_checked_at", "yyyy-MM-dd")).alias("last_checked_at"),
        "availability_status",
        "ad_expiry",
    )


def order_text_table_sql() -> str:
    return f"""
    SELECT ads_id,
           CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'garbage'
                ELSE CAST(o_orderdate AS VARCHAR) END AS first_seen,
           CASE WHEN o_orderkey % 97 = 0 THEN 'garbage' ELSE strftime(last_checked_at, '%Y-%m-%d') END AS last_checked_at,
           availability_status, ad_expiry
    FROM ({order_table_sql()}) t"""


def order_raw_listings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as raw text listings, as landed in raw CSV: rent/size labels, category label,
    room text, published date text and a raw type name."""
    o = T(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("ads_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(money_label(F.col("o_totalprice"))).alias("monthly_rent"),
        F.concat(case_col(F.col("o_orderpriority"), PRIORITY_CATEGORY), F.lit(", For rent")).alias("category_id"),
        F.when(k % 10 == 0, F.lit("unknown"))
         .otherwise(F.concat(F.format_number(F.floor(F.col("o_totalprice") / 100), 0), F.lit(" sq.ft."))).alias("size"),
        F.when(k % 9 == 0, F.lit("More than 10")).otherwise((k % 6).cast("double").cast("string")).alias("rooms"),
        F.when(k % 8 == 0, F.lit("bad-date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("publishedDatetime"),
        index_col(k % 7, CUSTOMER_TYPES).alias("property_type"),
        F.col("o_orderstatus").alias("state"),
    )


def order_raw_listings_sql() -> str:
    return f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
           CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {money_label_sql('o_totalprice')} END AS monthly_rent,
           {case_sql('o_orderpriority', PRIORITY_CATEGORY)} || ', For rent' AS category_id,
           CASE WHEN o_orderkey % 10 = 0 THEN 'unknown'
                ELSE format('{{:,.0f}}', floor(o_totalprice / 100)) || ' sq.ft.' END AS size,
           CASE WHEN o_orderkey % 9 = 0 THEN 'More than 10' ELSE CAST(CAST(o_orderkey % 6 AS DOUBLE) AS VARCHAR) END AS rooms,
           CASE WHEN o_orderkey % 8 = 0 THEN 'bad-date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS publishedDatetime,
           {index_sql('o_orderkey % 7', CUSTOMER_TYPES)} AS property_type,
           o_orderstatus AS state
    FROM orders"""


EVENT_CATEGORY = {
    "view": "Apartment / Condominium",
    "click": "Room",
    "signup": "House",
    "purchase": "Land",
    "error": "Commercial Property",
}


def event_raw_listings(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw text listing rows (the raw-file layout)."""
    e = T(spark, d, "events")
    u = F.col("user_id")
    return e.select(
        F.col("event_id").cast("string").alias("ads_id"),
        money_label(F.col("value")).alias("monthly_rent"),
        index_col(u % 7, CUSTOMER_TYPES).alias("property_type"),
        (u % 7).cast("string").alias("property_type_id"),
        F.concat(case_col(F.col("event_type"), EVENT_CATEGORY), F.lit(", For rent")).alias("category_id"),
        F.concat(F.lit("s"), (u % 4).cast("string")).alias("state"),
        (u % 5).cast("double").cast("string").alias("rooms"),
        F.concat(F.floor("value").cast("string"), F.lit(" sq.ft.")).alias("size"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("publishedDatetime"),
        F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"),
    )


def event_raw_listings_sql() -> str:
    return f"""
    SELECT CAST(event_id AS VARCHAR) AS ads_id, {money_label_sql('value')} AS monthly_rent,
           {index_sql('user_id % 7', CUSTOMER_TYPES)} AS property_type,
           {case_sql('event_type', EVENT_CATEGORY)} || ', For rent' AS category_id,
           's' || CAST(user_id % 4 AS VARCHAR) AS state,
           CAST(CAST(user_id % 5 AS DOUBLE) AS VARCHAR) AS rooms,
           CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' sq.ft.' AS size,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS publishedDatetime
    FROM events"""


def order_load_listings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as raw listings with coarse content (rent bucket, status, rooms, year), so
    many rows are content duplicates of each other."""
    o = T(spark, d, "orders")
    k = F.col("o_orderkey")
    rent = (F.floor(F.col("o_totalprice") / 100000) * 1000)
    return o.select(
        k.cast("string").alias("ads_id"),
        F.concat(F.lit("RM "), F.format_number(rent, 0), F.lit(" per month")).alias("monthly_rent"),
        F.concat(case_col(F.col("o_orderpriority"), PRIORITY_CATEGORY), F.lit(", For rent")).alias("category_id"),
        F.col("o_orderstatus").alias("state"),
        (k % 3).cast("string").alias("rooms"),
        index_col(k % 7, CUSTOMER_TYPES).alias("property_type"),
        (k % 7).cast("string").alias("property_type_id"),
        F.date_format("o_orderdate", "yyyy-01-01").alias("publishedDatetime"),
        F.lit("2026-05-01").alias("scrape_date"),
    )


def order_load_listings_sql() -> str:
    return f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
           'RM ' || format('{{:,}}', CAST(floor(o_totalprice / 100000) * 1000 AS BIGINT)) || ' per month' AS monthly_rent,
           {case_sql('o_orderpriority', PRIORITY_CATEGORY)} || ', For rent' AS category_id,
           o_orderstatus AS state, CAST(o_orderkey % 3 AS VARCHAR) AS rooms,
           {index_sql('o_orderkey % 7', CUSTOMER_TYPES)} AS property_type,
           strftime(o_orderdate, '%Y-01-01') AS publishedDatetime, '2026-05-01' AS scrape_date
    FROM orders"""
