"""Registered queries: each runs library operators over stand-in inputs built from the
test tables (``bindings``), paired with an equivalent DuckDB SQL oracle.

Every query reads whole tables; limits appear only where the cap is the feature (L1
due cap, L3 top/bottom report). Dates and timestamps are returned as text so both
engines hash them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import functions as LF
from letwise.operators import audits as A
from letwise.operators.availability import (
    availability_summary,
    due_listings,
    probe_outcomes,
    recheck,
    snapshot_diff,
    with_due_flag,
)
from letwise.operators.clean import clean_listings, exclude_categories, mapping_dimension, standardise_type
from letwise.operators.dedup import content_dedup, latest_per_key
from letwise.operators.flatten import item_to_row
from letwise.operators.geo import backfill_coordinates, bbox_report, missing_coordinates, resolve_pairs
from letwise.operators.joins import skip_known
from letwise.operators.slices import combine_slices
from letwise.operators.upsert import evolve_schema, upsert
from letwise.plans import bindings as B
from letwise.plans import sqlfrag as Q
from letwise.session import scratch_path
from letwise.sources.files import read_pages, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TODAY_RECHECK = "2001-07-15"
TODAY_GONE = "2000-01-01"
EXCLUDED_SQL = Q.in_list(K.EXCLUDED_CATEGORIES)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ymd(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def _cleaned_customers(spark, d):
    raw = B.customer_listings(spark, d).drop("c_mktsegment", "c_custkey")
    return clean_listings(raw, mapping_dimension(spark))


_CLEANED_CUSTOMERS_SQL = f"""
    l AS ({B.customer_listings_sql()}),
    c AS (SELECT l.ads_id, l.state, l.region, {Q.clean_rent('l.monthly_rent')} AS monthly_rent,
                 {Q.strip_category('l.category_id')} AS category_id, {Q.standard_type('l.property_type')} AS CPI
          FROM l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key),
    k AS (SELECT * FROM c WHERE category_id NOT IN ({EXCLUDED_SQL}))"""


# --------------------------------------------------------------------------- A1 flagship
@register("rent_report", f"""WITH {_CLEANED_CUSTOMERS_SQL}
SELECT state, CPI, {Q.rent_summary_aggs()} FROM k GROUP BY state, CPI""")
def rent_report(spark: SparkSession, d: str) -> DataFrame:
    """Scan -> F1 rent -> F5/W2 exclusion -> J2 standard type -> A1 per (state, CPI)."""
    return A.rent_summary(_cleaned_customers(spark, d), by=("state", "CPI"))


@register("rent_by_state", f"""WITH {_CLEANED_CUSTOMERS_SQL}
SELECT state, {Q.rent_summary_aggs()} FROM k GROUP BY state""")
def rent_by_state(spark: SparkSession, d: str) -> DataFrame:
    """A1: count, mean and median rent per state after cleaning and exclusion."""
    return A.rent_summary(_cleaned_customers(spark, d), by=("state",))


@register("rent_by_category", f"""WITH {_CLEANED_CUSTOMERS_SQL}
SELECT category_id, {Q.rent_summary_aggs()} FROM k GROUP BY category_id""")
def rent_by_category(spark: SparkSession, d: str) -> DataFrame:
    """A2: rent statistics per category, so rooms never mix with whole units."""
    return A.rent_summary(_cleaned_customers(spark, d), by=("category_id",))


@register("rent_by_cpi", f"""WITH l AS ({B.part_listings_sql()}),
c AS (SELECT {Q.clean_rent('l.monthly_rent')} AS monthly_rent, {Q.standard_type('l.property_type')} AS CPI
      FROM l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key)
SELECT CPI, {Q.rent_summary_aggs()} FROM c GROUP BY CPI""")
def rent_by_cpi(spark: SparkSession, d: str) -> DataFrame:
    """A3: rent statistics per standard type."""
    raw = B.part_listings(spark, d).drop("p_partkey")
    return A.rent_summary(clean_listings(raw, mapping_dimension(spark)), by=("CPI",))


@register("state_rank", f"""WITH {_CLEANED_CUSTOMERS_SQL},
s AS (SELECT region, {Q.rent_summary_aggs()} FROM k GROUP BY region)
SELECT *, CAST(rank() OVER (ORDER BY mean_rent DESC NULLS LAST) AS BIGINT) AS rank_desc,
          CAST(rank() OVER (ORDER BY mean_rent ASC NULLS LAST) AS BIGINT) AS rank_asc FROM s""")
def state_rank(spark: SparkSession, d: str) -> DataFrame:
    """Rank areas by mean rent (over the aggregated rows)."""
    return A.rank_groups(A.rent_summary(_cleaned_customers(spark, d), by=("region",)))


@register("top_states", f"""WITH {_CLEANED_CUSTOMERS_SQL},
s AS (SELECT region, {Q.rent_summary_aggs()} FROM k GROUP BY region)
(SELECT *, 'top' AS side FROM s ORDER BY mean_rent DESC NULLS LAST, region LIMIT 3)
UNION ALL
(SELECT *, 'bottom' AS side FROM s ORDER BY mean_rent ASC NULLS LAST, region LIMIT 2)""")
def top_states(spark: SparkSession, d: str) -> DataFrame:
    """L3: top 3 and bottom 2 areas by mean rent."""
    s = A.rent_summary(_cleaned_customers(spark, d), by=("region",))
    return A.top_bottom(s, key="region")


# --------------------------------------------------------------------------- scalar functions
@register("json_attr", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_attr(spark: SparkSession, d: str) -> DataFrame:
    """one attribute of a JSON object text."""
    e = read_table(spark, d, "events")
    return e.select("event_id", LF.json_attribute("props", "k").try_cast("bigint").alias("k"))


def _rent_label_input(o):
    k = F.col("o_orderkey")
    p = F.col("o_totalprice")
    return (F.when(k % 11 == 0, F.concat(F.lit("RM"), F.format_number(p, 2)))
            .when(k % 13 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.lit("invalid"))
            .when(k % 19 == 0, F.format_number(p, 0))
            .otherwise(B.money_label(p)))


_RENT_LABEL_SQL = f"""(CASE WHEN o_orderkey % 11 = 0 THEN 'RM' || format('{{:,.2f}}', o_totalprice)
      WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'invalid'
      WHEN o_orderkey % 19 = 0 THEN format('{{:,.0f}}', o_totalprice)
      ELSE {B.money_label_sql('o_totalprice')} END)"""


@register("clean_rent", f"""SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, {Q.clean_rent(_RENT_LABEL_SQL)} AS monthly_rent FROM orders""")
def clean_rent(spark: SparkSession, d: str) -> DataFrame:
    """F1 over rent labels (well-formed, glued prefix, missing, junk, bare numbers)."""
    o = read_table(spark, d, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("ads_id"), _rent_label_input(o).alias("label"))
    return raw.select("ads_id", LF.clean_rent("label").alias("monthly_rent"))


@register("clean_size", f"""SELECT p_partkey, {Q.clean_size("CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'unknown' ELSE format('{:,.0f}', CAST(p_size * 100 AS DOUBLE)) || ' sq.ft.' END")} AS size FROM part""")
def clean_size(spark: SparkSession, d: str) -> DataFrame:
    """F2 over size labels."""
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    label = (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("unknown"))
             .otherwise(F.concat(F.format_number(F.col("p_size") * 100, 0), F.lit(" sq.ft."))))
    return p.select("p_partkey", LF.clean_size(label).alias("size"))


@register("clean_rooms", f"""SELECT key, rooms_in, {Q.clean_rooms('rooms_in')} AS rooms FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, CAST(l_quantity AS VARCHAR) AS rooms_in FROM lineitem
  UNION ALL
  SELECT 'p' || CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END FROM part)""")
def clean_rooms(spark: SparkSession, d: str) -> DataFrame:
    """F3 over numeric room texts (``'23.0'``) and labels."""
    li = read_table(spark, d, "lineitem")
    p = read_table(spark, d, "part")
    a = li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("key"),
                  F.col("l_quantity").cast("string").alias("rooms_in"))
    k = F.col("p_partkey")
    b = p.select(F.concat(F.lit("p"), k.cast("string")).alias("key"),
                 F.when(k % 4 == 0, F.lit("")).when(k % 5 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("p_name")).alias("rooms_in"))
    u = a.unionByName(b)
    return u.select("key", "rooms_in", LF.clean_rooms("rooms_in").alias("rooms"))


_PUB_SQL = """(CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%d')
      WHEN event_id % 7 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M')
      WHEN event_id % 11 = 0 THEN 'bad-date' WHEN event_id % 13 = 0 THEN NULL
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END)"""


@register("publish_date", f"""SELECT event_id, {Q.publish_date(_PUB_SQL)} AS publishedDatetime FROM events""")
def publish_date(spark: SparkSession, d: str) -> DataFrame:
    """mixed published-date texts -> ``MM/dd/yyyy`` or ``''``."""
    e = read_table(spark, d, "events")
    k = F.col("event_id")
    text = (F.when(k % 5 == 0, F.date_format("ts", "yyyy-MM-dd"))
            .when(k % 7 == 0, F.date_format("ts", "dd/MM/yyyy HH:mm"))
            .when(k % 11 == 0, F.lit("bad-date"))
            .when(k % 13 == 0, F.lit(None).cast("string"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", LF.publish_date(text).alias("publishedDatetime"))


@register("category_exclude", f"""SELECT ads_id, category_id FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
         {Q.strip_category(B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY) + " || ', For rent'")} AS category_id
  FROM orders) WHERE category_id NOT IN ({EXCLUDED_SQL})""")
def category_exclude(spark: SparkSession, d: str) -> DataFrame:
    """F5 + W2: strip the suffix and drop excluded categories; missing categories stay."""
    o = read_table(spark, d, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("ads_id"),
                   F.concat(B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY), F.lit(", For rent")).alias("category_id"))
    return exclude_categories(raw)


@register("type_standardise", f"""SELECT l.p_partkey, l.property_type, {Q.standard_type('l.property_type')} AS CPI
FROM ({B.part_listings_sql()}) l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key""")
def type_standardise(spark: SparkSession, d: str) -> DataFrame:
    """J2 + F10: raw type -> standard type through the fixed mapping dimension."""
    raw = B.part_listings(spark, d).select("p_partkey", "property_type")
    return standardise_type(raw, mapping_dimension(spark))


_ADDR_BASE_SQL = """SELECT c_custkey,
   CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '  ' ELSE c_name END AS building,
   CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' ' || n_name || ' ' END AS subarea,
   CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE r_name END AS state
   FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@register("address", f"""SELECT c_custkey,
  concat_ws(', ', CASE WHEN trim(building) <> '' THEN building END, CASE WHEN trim(subarea) <> '' THEN subarea END,
            CASE WHEN trim(state) <> '' THEN state END) AS address,
  CASE WHEN concat_ws(', ', CASE WHEN trim(building) <> '' THEN trim(building) END, CASE WHEN trim(subarea) <> '' THEN trim(subarea) END,
            CASE WHEN trim(state) <> '' THEN trim(state) END) = '' THEN ''
       ELSE concat_ws(', ', CASE WHEN trim(building) <> '' THEN trim(building) END, CASE WHEN trim(subarea) <> '' THEN trim(subarea) END,
            CASE WHEN trim(state) <> '' THEN trim(state) END) || ', Malaysia' END AS geo_query
FROM ({_ADDR_BASE_SQL})""")
def address(spark: SparkSession, d: str) -> DataFrame:
    """P4 + P5: address from non-blank parts (untrimmed) and the trimmed geocode query."""
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    s = j.select(
        "c_custkey",
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("  ")).otherwise(F.col("c_name")).alias("building"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))).alias("subarea"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("state"),
    )
    return s.select("c_custkey", LF.address("building", "subarea", "state").alias("address"),
                    LF.geocode_query("building", "subarea", "state").alias("geo_query"))


@register("slug", """SELECT p_partkey, CASE WHEN s = '' THEN 'type' ELSE s END AS slug FROM (
  SELECT p_partkey, trim(regexp_replace(lower(trim(p_name || ' ' || p_brand)), '[^\\w]+', '_', 'g'), '_') AS s FROM part)""")
def slug(spark: SparkSession, d: str) -> DataFrame:
    """Folder-safe slug of a type name."""
    p = read_table(spark, d, "part")
    return p.select("p_partkey", LF.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("slug"))


# --------------------------------------------------------------------------- S1 + P1
_PAGE_ATTR_SQL = f"""SELECT o_orderkey,
   CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'RM ' || format('{{:,.0f}}', o_totalprice) END AS price_label,
   {B.index_sql('o_orderkey % 7', B.CUSTOMER_TYPES)} AS property_type_name,
   {B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY)} AS category_name,
   n_name AS region_name,
   CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE c_name END AS subarea_name,
   CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN '  ' ELSE 'Block ' || o_orderstatus END AS building_name,
   CASE WHEN o_orderkey % 6 = 0 THEN '0' WHEN o_orderkey % 8 = 0 THEN NULL
        ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) END AS size,
   CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS published_date,
   strftime(o_orderdate, '%Y-%m-%d') AS date
   FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _trimmed_part(x):
    return f"CASE WHEN trim({x}) <> '' THEN trim({x}) END"


def _kept_part(x):
    return f"CASE WHEN trim({x}) <> '' THEN {x} END"


_GQ = f"concat_ws(', ', {_trimmed_part('building_name')}, {_trimmed_part('subarea_name')}, {_trimmed_part('region_name')})"


@register("page_flatten", f"""SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
  CASE WHEN {Q.present('price_label')} THEN price_label || ' per month' ELSE '' END AS monthly_rent,
  coalesce(property_type_name, '') AS property_type,
  CASE WHEN {Q.present('category_name')} THEN category_name || ', For rent' ELSE '' END AS category_id,
  coalesce(region_name, '') AS state, coalesce(subarea_name, '') AS region,
  CASE WHEN {Q.present('size')} AND size <> '0' THEN trim(size || ' sq.ft.') ELSE '' END AS size,
  concat_ws(', ', {_kept_part('building_name')}, {_kept_part('subarea_name')}, {_kept_part('region_name')}) AS address,
  coalesce(CASE WHEN published_date <> '' THEN published_date END, date, '') AS publishedDatetime,
  CASE WHEN {_GQ} = '' THEN '' ELSE {_GQ} || ', Malaysia' END AS geo_query
FROM ({_PAGE_ATTR_SQL})""")
def page_flatten(spark: SparkSession, d: str) -> DataFrame:
    """S1 + P1-P6: search pages landed as JSON lines (200 items per page), scanned with
    the page schema, exploded and flattened to listing rows."""
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    attrs = F.struct(
        k.cast("string").alias("list_id"),
        F.when(k % 10 != 0, F.concat(F.lit("RM "), F.format_number("o_totalprice", 0))).alias("price_label"),
        B.index_col(k % 7, B.CUSTOMER_TYPES).alias("property_type_name"),
        (k % 7).cast("string").alias("property_type_id"),
        B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY).alias("category_name"),
        F.col("n_name").alias("region_name"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("c_name")).alias("subarea_name"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 4 == 0, F.lit("  "))
         .otherwise(F.concat(F.lit("Block "), F.col("o_orderstatus"))).alias("building_name"),
        F.when(k % 6 == 0, F.lit("0")).when(k % 8 == 0, F.lit(None).cast("string"))
         .otherwise(F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string")).alias("size"),
        F.lit("sq.ft.").alias("size_suffix"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("published_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    items = j.select((k / K.PAGE_SIZE).cast("bigint").alias("page_no"),
                     F.struct(k.alias("id"), attrs.alias("attributes")).alias("item"))
    pages = items.groupBy("page_no").agg(F.collect_list("item").alias("data"),
                                         F.count(F.lit(1)).alias("n"))
    text = pages.select(F.to_json(F.struct(
        F.col("data"), F.struct(F.col("n").alias("total-results"), F.col("n").alias("total-showing")).alias("meta")
    )).alias("value"))
    path = scratch_path(spark, "pages")
    text.write.text(path)
    rows = item_to_row(read_pages(spark, path))
    return rows.select("ads_id", "monthly_rent", "property_type", "category_id", "state", "region", "size",
                       "address", "publishedDatetime", "geo_query")


# --------------------------------------------------------------------------- joins / dedup
@register("skip_known", """SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = CAST(o_orderkey AS VARCHAR))""")
def skip_known_q(spark: SparkSession, d: str) -> DataFrame:
    """Incoming listings whose id is not already known (left anti join)."""
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem")
    incoming = o.select(F.col("o_orderkey").cast("string").alias("ads_id"), "o_orderstatus")
    known = li.select(F.col("l_orderkey").cast("string").alias("ads_id"))
    return skip_known(incoming, known)


@register("key_dedup", """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_partkey, l_suppkey,
       l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def key_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Latest row per key (ship date, then part, supplier, price)."""
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    out = latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", ymd("l_shipdate").alias("ship_date"), "l_partkey", "l_suppkey",
                      "l_extendedprice", "l_quantity")


@register("combine_slices", """SELECT ads_id, o_orderstatus, o_orderpriority, slice_no FROM (
  SELECT *, row_number() OVER (PARTITION BY ads_id ORDER BY slice_no) AS rn FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderstatus, o_orderpriority, 0 AS slice_no FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority, 1 FROM orders WHERE o_orderstatus = 'O' OR o_orderkey % 10 = 0
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, NULL, 2 FROM orders WHERE o_orderstatus = 'P'))
WHERE rn = 1""")
def combine_slices_q(spark: SparkSession, d: str) -> DataFrame:
    """U1 + D1: per-slice pulls (overlapping; one lacks a column) unioned, first slice wins."""
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("ads_id"), "o_orderstatus", "o_orderpriority", "o_orderkey")
    f = o.where(F.col("o_orderstatus") == "F").drop("o_orderkey")
    s = o.where((F.col("o_orderstatus") == "O") | (F.col("o_orderkey") % 10 == 0)).drop("o_orderkey")
    p = o.where(F.col("o_orderstatus") == "P").drop("o_orderkey", "o_orderpriority")
    out = combine_slices([f, s, p])
    return out.select("ads_id", "o_orderstatus", "o_orderpriority", "slice_no")


@register("content_dedup", """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS ads_id,
     CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END AS p_type, p_size,
     CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS p_brand, p_retailprice FROM part)
SELECT * FROM p WHERE ads_id IN (SELECT min(ads_id) FROM p GROUP BY p_type, p_size, p_brand)""")
def content_dedup_q(spark: SparkSession, d: str) -> DataFrame:
    """Content duplicates (NULL = NULL) collapse to the smallest text id."""
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    t = p.select(k.cast("string").alias("ads_id"),
                 F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("p_type"),
                 "p_size",
                 F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("p_brand"),
                 "p_retailprice")
    return content_dedup(t, ["p_type", "p_size", "p_brand"])


# --------------------------------------------------------------------------- table mutation
_UPSERT_SQL = """WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_totalprice AS monthly_rent, o_orderpriority AS state, o_orderstatus AS CPI,
         '2026-05-01' AS scrape_date, DATE '2026-05-01' AS first_seen,
         CASE WHEN o_orderkey % 4 = 0 THEN DATE '2026-05-05' END AS last_checked_at,
         CASE WHEN o_orderkey % 7 = 0 THEN 'rented' ELSE 'active' END AS availability_status,
         CASE WHEN o_orderkey % 7 = 0 THEN DATE '2026-05-10' END AS gone_at
  FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_totalprice * 2 AS monthly_rent, o_orderstatus AS CPI,
         CASE WHEN o_orderkey % 22 = 0 THEN '2026-04-20' ELSE '2026-05-20' END AS scrape_date
  FROM orders WHERE o_orderkey % 2 = 0),
j AS (SELECT t.*, b.ads_id AS b_id, b.monthly_rent AS b_rent, b.CPI AS b_cpi, b.scrape_date AS b_sd,
        (b.ads_id IS NOT NULL AND NOT (t.ads_id IS NOT NULL AND CAST(b.scrape_date AS DATE) < CAST(t.scrape_date AS DATE))) AS take,
        t.ads_id IS NOT NULL AS in_t
      FROM t FULL OUTER JOIN b ON t.ads_id = b.ads_id)
SELECT CASE WHEN take THEN b_id ELSE ads_id END AS ads_id,
       CASE WHEN take THEN b_rent ELSE monthly_rent END AS monthly_rent,
       CASE WHEN take THEN NULL ELSE state END AS state,
       CASE WHEN take THEN b_cpi ELSE CPI END AS CPI,
       CASE WHEN take THEN b_sd ELSE scrape_date END AS scrape_date,
       strftime(CASE WHEN take AND NOT in_t THEN CAST(b_sd AS DATE) ELSE first_seen END, '%Y-%m-%d') AS first_seen,
       strftime(CASE WHEN take AND in_t THEN CAST(b_sd AS DATE) WHEN take THEN NULL ELSE last_checked_at END, '%Y-%m-%d') AS last_checked_at,
       CASE WHEN take THEN 'active' ELSE availability_status END AS availability_status,
       strftime(CASE WHEN take THEN NULL ELSE gone_at END, '%Y-%m-%d') AS gone_at
FROM j"""


def upsert_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A table (keys not divisible by 3, some rented) and a batch (every 2nd key, new prices, no state column, some
    rows late)."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    base = o.where(k % 3 != 0).select(
        k.cast("string").alias("ads_id"), F.col("o_totalprice").alias("monthly_rent"),
        F.col("o_orderpriority").alias("state"), F.col("o_orderstatus").alias("CPI"),
        F.lit("2026-05-01").alias("scrape_date"), F.to_date(F.lit("2026-05-01")).alias("first_seen"),
        F.when(k % 4 == 0, F.to_date(F.lit("2026-05-05"))).alias("last_checked_at"),
        F.when(k % 7 == 0, F.lit("rented")).otherwise(F.lit("active")).alias("availability_status"),
        F.when(k % 7 == 0, F.to_date(F.lit("2026-05-10"))).alias("gone_at"))
    batch = o.where(k % 2 == 0).select(
        k.cast("string").alias("ads_id"), (F.col("o_totalprice") * 2).alias("monthly_rent"),
        F.col("o_orderstatus").alias("CPI"),
        F.when(k % 22 == 0, F.lit("2026-04-20")).otherwise(F.lit("2026-05-20")).alias("scrape_date"))
    return base, batch


@register("upsert", _UPSERT_SQL)
def upsert_q(spark: SparkSession, d: str) -> DataFrame:
    """M1 + J7: a batch merged into a table."""
    out = upsert(*upsert_inputs(spark, d))
    return out.select("ads_id", "monthly_rent", "state", "CPI", "scrape_date", ymd("first_seen").alias("first_seen"),
                      ymd("last_checked_at").alias("last_checked_at"), "availability_status", ymd("gone_at").alias("gone_at"))


@register("schema_evolve", """SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderpriority AS state,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS scrape_date,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS first_seen,
  CAST(NULL AS VARCHAR) AS last_checked_at, 'active' AS availability_status, CAST(NULL AS VARCHAR) AS gone_at,
  CAST(NULL AS VARCHAR) AS CPI, CAST(NULL AS DOUBLE) AS latitude FROM orders""")
def schema_evolve(spark: SparkSession, d: str) -> DataFrame:
    """M4 + P8: an old table without the re-check and type columns gains them; old rows
    are seeded (first seen = scrape date, status active)."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    old = o.select(k.cast("string").alias("ads_id"), F.col("o_orderpriority").alias("state"),
                   F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(ymd("o_orderdate")).alias("scrape_date"))
    t = evolve_schema(old)
    return t.select("ads_id", "state", "scrape_date", ymd("first_seen").alias("first_seen"),
                    ymd("last_checked_at").alias("last_checked_at"), "availability_status",
                    ymd("gone_at").alias("gone_at"), "CPI", "latitude")


# --------------------------------------------------------------------------- availability
_TEXT_TABLE = B.order_text_table_sql()


@register("due_for_check", f"""SELECT ads_id,
  {Q.age_days('first_seen', TODAY_RECHECK)} AS age_days,
  {Q.interval(Q.age_days('first_seen', TODAY_RECHECK))} AS interval_days,
  {Q.due('first_seen', 'last_checked_at', 'availability_status', TODAY_RECHECK)} AS due
FROM ({_TEXT_TABLE})""")
def due_for_check(spark: SparkSession, d: str) -> DataFrame:
    """W3 + W4 + F6-F8: due flag under the decay policy (text dates, some garbage)."""
    t = B.order_text_table(spark, d)
    age = LF.age_days("first_seen", TODAY_RECHECK)
    out = with_due_flag(t, TODAY_RECHECK, out="due")
    return out.select("ads_id", age.cast("bigint").alias("age_days"),
                      LF.recheck_interval(age).cast("bigint").alias("interval_days"), "due")


@register("due_capped", f"""SELECT ads_id, last_checked_at FROM ({_TEXT_TABLE})
WHERE {Q.due('first_seen', 'last_checked_at', 'availability_status', TODAY_RECHECK)}
ORDER BY {Q.parse_day('last_checked_at')} ASC NULLS FIRST, ads_id ASC LIMIT 500""")
def due_capped(spark: SparkSession, d: str) -> DataFrame:
    """L1: the 500 least recently checked due listings (never checked first, then by id)."""
    t = B.order_text_table(spark, d)
    return due_listings(t, TODAY_RECHECK, limit=500, columns=("ads_id", "last_checked_at"))


_EXPIRY_SQL = """(CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate + INTERVAL 39 DAY, '%Y-%m-%d')
      WHEN o_orderkey % 17 = 0 THEN 'not-a-date' WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
      ELSE strftime(o_orderdate + INTERVAL 39 DAY, '%Y-%m-%d %H:%M:%S') END)"""


@register("classify_gone", f"""SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, {Q.classify_gone(_EXPIRY_SQL, TODAY_GONE)} AS status FROM orders""")
def classify_gone(spark: SparkSession, d: str) -> DataFrame:
    """rented (gone before the expiry day) vs expired (on/after it, or no valid expiry)."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    exp = F.col("o_orderdate") + F.expr("INTERVAL 39 DAYS")
    text = (F.when(k % 13 == 0, F.date_format(exp, "yyyy-MM-dd"))
            .when(k % 17 == 0, F.lit("not-a-date"))
            .when(k % 19 == 0, F.lit(None).cast("string"))
            .when(k % 23 == 0, F.lit(""))
            .otherwise(F.date_format(exp, "yyyy-MM-dd HH:mm:ss")))
    return o.select(k.cast("string").alias("ads_id"), LF.classify_gone(text, TODAY_GONE).alias("status"))


_AVAIL_SQL = f"""WITH t AS ({B.order_table_sql()}),
d AS (SELECT *, {Q.due('first_seen', 'last_checked_at', 'availability_status', TODAY_RECHECK)} AS due,
        CASE WHEN o_orderkey % 50 = 0 THEN 'unknown' WHEN n_lines > 0 THEN 'alive' ELSE 'gone' END AS outcome FROM t),
r AS (SELECT ads_id, state,
  CASE WHEN due AND outcome = 'gone' THEN {Q.classify_gone('ad_expiry', TODAY_RECHECK)} ELSE availability_status END AS availability_status,
  strftime(CASE WHEN due AND outcome IN ('alive', 'gone') THEN {Q.day(TODAY_RECHECK)} ELSE last_checked_at END, '%Y-%m-%d') AS last_checked_at,
  strftime(CASE WHEN due AND outcome = 'gone' THEN {Q.day(TODAY_RECHECK)} ELSE gone_at END, '%Y-%m-%d') AS gone_at
  FROM d)"""


def _availability(spark: SparkSession, d: str) -> DataFrame:
    t = B.order_table(spark, d).select("ads_id", "state", "first_seen", "last_checked_at", "availability_status",
                                       "gone_at", "ad_expiry")
    outcomes = probe_outcomes(B.order_probe_log(spark, d))
    return recheck(t, outcomes, TODAY_RECHECK)


@register("availability", _AVAIL_SQL + "\nSELECT * FROM r")
def availability(spark: SparkSession, d: str) -> DataFrame:
    """M3 + J6 + S2: latest probe per listing applied to the due listings."""
    out = _availability(spark, d)
    return out.select("ads_id", "state", "availability_status", ymd("last_checked_at").alias("last_checked_at"),
                      ymd("gone_at").alias("gone_at"))


@register("availability_summary", _AVAIL_SQL + """
SELECT state, count(*) AS n_total,
  count(CASE WHEN coalesce(availability_status, 'active') = 'active' THEN 1 END) AS n_active,
  count(CASE WHEN availability_status = 'rented' THEN 1 END) AS n_rented,
  count(CASE WHEN availability_status = 'expired' THEN 1 END) AS n_expired
FROM r GROUP BY state""")
def availability_summary_q(spark: SparkSession, d: str) -> DataFrame:
    """Listings per status per state after the re-check."""
    return availability_summary(_availability(spark, d), by=("state",))


_CUT = "2024-01-30 12:00:00"


@register("snapshot_diff", f"""WITH t AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ads_id, 's' || CAST(user_id % 4 AS VARCHAR) AS state
           FROM events WHERE ts < TIMESTAMP '{_CUT}'),
f AS (SELECT CAST(user_id AS VARCHAR) AS ads_id, 's' || CAST(user_id % 4 AS VARCHAR) AS state
      FROM events WHERE ts >= TIMESTAMP '{_CUT}' AND user_id % 4 <> 3),
done AS (SELECT DISTINCT state FROM f)
SELECT ads_id, state,
  CASE WHEN ads_id IN (SELECT ads_id FROM f) THEN 'present'
       WHEN state IN (SELECT state FROM done) THEN 'absent' ELSE 'unverified' END AS diff
FROM t""")
def snapshot_diff_q(spark: SparkSession, d: str) -> DataFrame:
    """J8 + U2: active listings vs a fresh pull in which one slice failed."""
    e = read_table(spark, d, "events")
    cut = F.lit(_CUT).cast("timestamp_ntz")
    sl = F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string"))
    table = e.where(F.col("ts") < cut).select(F.col("user_id").cast("string").alias("ads_id"), sl.alias("state")) \
             .distinct().withColumn("availability_status", F.lit("active"))
    fresh = e.where((F.col("ts") >= cut) & (F.col("user_id") % 4 != 3)) \
             .select(F.col("user_id").cast("string").alias("ads_id"), sl.alias("state"))
    # what the source reported per state; the fourth state's pull failed
    reported = e.where(F.col("ts") >= cut).groupBy(sl.alias("state")).agg(F.count(F.lit(1)).alias("total_results"))
    done = A.completed_slices(A.slice_coverage(reported, fresh, ["state"], depth_cap=1 << 60))
    return snapshot_diff(table, fresh, done, ["state"])


# --------------------------------------------------------------------------- geo
def _geo_inputs(spark: SparkSession, d: str):
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    dbl = lambda x: F.lit(float(x))
    table = j.select(
        k.cast("string").alias("ads_id"),
        F.when(k % 7 == 0, F.lit("")).when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("region"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("state"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(dbl(3) + (k % 40).cast("double") / dbl(10)).alias("latitude"),
        F.when((k % 5 == 0) | (k % 17 == 0), F.lit(None).cast("double"))
         .otherwise(dbl(101) + (k % 50).cast("double") / dbl(10)).alias("longitude"),
    )
    nk = F.col("n_nationkey")
    miss = nk % 6 == 0
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    g_nation = nr.where((nk % 3 != 0) | miss).select(
        F.concat_ws(", ", "n_name", "r_name", F.lit(K.COUNTRY)).alias("query"),
        F.when(~miss, dbl(1) + nk.cast("double") * dbl(0.2)).alias("lat"),
        F.when(~miss, dbl(100) + nk.cast("double") * dbl(0.5)).alias("lon"))
    rk = F.col("r_regionkey")
    g_region = r.where(rk != 4).select(
        F.concat_ws(", ", "r_name", F.lit(K.COUNTRY)).alias("query"),
        (dbl(4) + rk.cast("double") * dbl(0.5)).alias("lat"), (dbl(110) + rk.cast("double")).alias("lon"))
    # every query a second time, with a smaller pair
    geo = g_nation.unionByName(g_region)
    return table, geo.unionByName(geo.select("query", (F.col("lat") - 1).alias("lat"), (F.col("lon") - 1).alias("lon")))


_GEO_SQL = """WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS ads_id,
    CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS region,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE r_name END AS state,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(3 AS DOUBLE) + CAST(c_custkey % 40 AS DOUBLE) / CAST(10 AS DOUBLE) END AS latitude,
    CASE WHEN c_custkey % 5 = 0 OR c_custkey % 17 = 0 THEN NULL ELSE CAST(101 AS DOUBLE) + CAST(c_custkey % 50 AS DOUBLE) / CAST(10 AS DOUBLE) END AS longitude
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT n_name || ', ' || r_name || ', Malaysia' AS query,
        CASE WHEN n_nationkey % 6 <> 0 THEN CAST(1 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.2 AS DOUBLE) END AS lat,
        CASE WHEN n_nationkey % 6 <> 0 THEN CAST(100 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS lon
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0 OR n_nationkey % 6 = 0
      UNION ALL
      SELECT r_name || ', Malaysia', CAST(4 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) * CAST(0.5 AS DOUBLE),
             CAST(110 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) FROM region WHERE r_regionkey <> 4),
gd AS (SELECT * FROM g UNION ALL SELECT query, lat - 1, lon - 1 FROM g),
gv AS (SELECT query, max(lat) AS lat, max(lon) AS lon FROM gd WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY query),
x AS (SELECT t.*, (latitude IS NULL OR longitude IS NULL) AS miss,
        CASE WHEN region IS NOT NULL AND region <> '' AND state IS NOT NULL AND state <> '' THEN region || ', ' || state || ', Malaysia' END AS q1,
        CASE WHEN state IS NOT NULL AND state <> '' THEN state || ', Malaysia' END AS q2 FROM t)
SELECT ads_id, region, state,
  CASE WHEN miss AND g1.lat IS NOT NULL THEN g1.lat WHEN miss AND g2.lat IS NOT NULL THEN g2.lat ELSE latitude END AS latitude,
  CASE WHEN miss AND g1.lat IS NOT NULL THEN g1.lon WHEN miss AND g2.lat IS NOT NULL THEN g2.lon ELSE longitude END AS longitude
FROM x LEFT JOIN gv g1 ON x.q1 = g1.query LEFT JOIN gv g2 ON x.q2 = g2.query"""


@register("geo_fill", _GEO_SQL)
def geo_fill(spark: SparkSession, d: str) -> DataFrame:
    """M2 + J4 + J5: fill missing coordinates from the fallback chain; queries repeat in the coordinate table."""
    table, geo = _geo_inputs(spark, d)
    return backfill_coordinates(table, geo)


@register("geo_fill_shuffle", _GEO_SQL)
def geo_fill_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """D3 -> J4 -> J5 step by step: the distinct pairs to fill, what the chain finds for each, joined back."""
    table, geo = _geo_inputs(spark, d)
    pairs = resolve_pairs(table, geo).select(F.col("region").alias("pr"), F.col("state").alias("ps"), "lat", "lon")
    j = table.join(pairs, F.col("region").eqNullSafe(F.col("pr")) & F.col("state").eqNullSafe(F.col("ps"))
                   & missing_coordinates(), "left")
    return j.select("ads_id", "region", "state", F.coalesce("lat", "latitude").alias("latitude"),
                    F.when(F.col("lat").isNotNull(), F.col("lon")).otherwise(F.col("longitude")).alias("longitude"))


@register("bbox_check", f"""SELECT state,
  count(CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 1 END) AS n_with_coords,
  count(CASE WHEN lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat BETWEEN {K.BBOX_LAT[0]} AND {K.BBOX_LAT[1]}
                                                             AND lon BETWEEN {K.BBOX_LON[0]} AND {K.BBOX_LON[1]}) THEN 1 END) AS n_outside,
  count(CASE WHEN NOT (lat IS NOT NULL AND lon IS NOT NULL) THEN 1 END) AS n_missing
FROM (SELECT r_name AS state,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS DOUBLE) / CAST(10 AS DOUBLE) END AS lat,
        CAST(95 AS DOUBLE) + CAST(c_custkey % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
GROUP BY state""")
def bbox_check(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates outside the country box, per state."""
    t = B.customer_listings(spark, d)
    k = F.col("c_custkey")
    t = t.select("state",
                 F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise((k % 100).cast("double") / F.lit(10.0)).alias("latitude"),
                 (F.lit(95.0) + (k % 300).cast("double") / F.lit(10.0)).alias("longitude"))
    return bbox_report(t, by=("state",))


# --------------------------------------------------------------------------- audits
@register("category_drift", f"""WITH s AS (SELECT DISTINCT CASE WHEN c_custkey % 100 = 0 THEN lower(c_mktsegment)
                                   ELSE {B.case_sql('c_mktsegment', B.SEGMENT_CATEGORY)} END AS category FROM customer),
a AS (SELECT * FROM (VALUES {', '.join('(' + Q.q(x) + ')' for x in K.ALLOWED_CATEGORIES)}) AS v(category))
SELECT category, 'unexpected' AS issue FROM s WHERE category IS NOT NULL AND category NOT IN (SELECT category FROM a)
UNION ALL
SELECT category, 'missing' AS issue FROM a WHERE category NOT IN (SELECT category FROM s WHERE category IS NOT NULL)""")
def category_drift(spark: SparkSession, d: str) -> DataFrame:
    """A4 + U3: observed category domain vs the allowed closed set."""
    c = read_table(spark, d, "customer")
    cat = F.when(F.col("c_custkey") % 100 == 0, F.lower("c_mktsegment")) \
           .otherwise(B.case_col(F.col("c_mktsegment"), B.SEGMENT_CATEGORY))
    return A.category_drift(c.select(cat.alias("category")), "category")


@register("null_rate", f"""SELECT category_id, count(*) AS n,
  avg(CAST(rooms IS NULL AS DOUBLE)) AS null_rate_rooms, avg(CAST(size IS NULL AS DOUBLE)) AS null_rate_size,
  avg(CAST(latitude IS NULL AS DOUBLE)) AS null_rate_latitude
FROM (SELECT {B.case_sql('c_mktsegment', B.SEGMENT_CATEGORY)} AS category_id,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' OR c_custkey % 4 = 0 THEN NULL ELSE '3' END AS rooms,
        CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 850.0 END AS size,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 3.0 END AS latitude FROM customer)
GROUP BY category_id""")
def null_rate(spark: SparkSession, d: str) -> DataFrame:
    """A5: null share of rooms/size/coordinates per category (rooms missing on every Room row)."""
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    t = c.select(B.case_col(F.col("c_mktsegment"), B.SEGMENT_CATEGORY).alias("category_id"),
                 F.when((F.col("c_mktsegment") == "HOUSEHOLD") | (k % 4 == 0), F.lit(None).cast("string")).otherwise(F.lit("3")).alias("rooms"),
                 F.when(k % 6 == 0, F.lit(None).cast("double")).otherwise(F.lit(850.0)).alias("size"),
                 F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.lit(3.0)).alias("latitude"))
    return A.null_rates(t, ["rooms", "size", "latitude"], by=("category_id",))


_EVENT_FIELDS = {
    "list_id": "event_id", "monthly_rent": "value", "price_label": "event_type", "property_type_name": "props",
    "property_type_id": "user_id", "category_name": "event_type", "region_name": "user_id",
    "subarea_name": "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END",
    "rooms_name": "NULL", "bathroom_name": "NULL", "size": "value", "adview_url": "props",
    "ad_expiry": "ts", "date": "ts",
}


@register("field_presence", "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, CAST(count({e}) AS BIGINT) AS n_present, count({e}) > 0 AS present FROM events"
    for f, e in _EVENT_FIELDS.items()))
def field_presence(spark: SparkSession, d: str) -> DataFrame:
    """Required item fields present on at least one row of a batch."""
    e = read_table(spark, d, "events")
    cols = []
    for f, expr in _EVENT_FIELDS.items():
        c = F.lit(None).cast("string") if expr == "NULL" else F.expr(expr).cast("string")
        cols.append(c.alias(f))
    return A.field_presence(e.select(*cols))


@register("slice_coverage", f"""WITH j AS (SELECT o_orderstatus AS slice, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT slice, count(*) AS reported FROM j GROUP BY slice),
f AS (SELECT slice, count(*) AS fetched FROM j WHERE l_linenumber <= 3 GROUP BY slice)
SELECT coalesce(r.slice, f.slice) AS slice, coalesce(reported, 0) AS reported, coalesce(fetched, 0) AS fetched,
  CASE WHEN coalesce(reported, 0) > 0 THEN coalesce(fetched, 0) / coalesce(reported, 0) END AS coverage,
  coalesce(reported, 0) > {K.OFFSET_CAP} AS over_cap
FROM r FULL OUTER JOIN f ON r.slice = f.slice""")
def slice_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Reported totals vs rows reachable under a depth limit, per slice."""
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_orderstatus").alias("slice"), "l_linenumber")
    one = j.groupBy("slice").agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("l_linenumber") <= 3, 1)).alias("got"))
    return one.select("slice", *A.coverage_columns(F.col("total"), F.col("got")))


@register("type_leak", f"""SELECT p_brand AS property_type_id, {B.case_sql('p_type', B.PTYPE_CATEGORY)} AS category_id, count(*) AS n,
  coalesce({B.case_sql('p_type', B.PTYPE_CATEGORY)} IN ({EXCLUDED_SQL}), FALSE) AS excluded
FROM part GROUP BY 1, 2""")
def type_leak(spark: SparkSession, d: str) -> DataFrame:
    """Categories seen per requested type id, excluded ones flagged."""
    p = read_table(spark, d, "part")
    t = p.select(F.col("p_brand").alias("property_type_id"),
                 B.case_col(F.col("p_type"), B.PTYPE_CATEGORY).alias("category_id"))
    return A.type_leakage(t)


@register("contamination", f"""WITH t AS (SELECT n_name AS state, o_totalprice AS monthly_rent,
     {B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY)} AS category_id
     FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT state, count(*) AS n_all, count(CASE WHEN coalesce(category_id, '') IN ({EXCLUDED_SQL}) THEN 1 END) AS n_removed,
  {Q.exact_mean('monthly_rent')} AS mean_before,
  {Q.exact_mean(f"CASE WHEN NOT (coalesce(category_id, '') IN ({EXCLUDED_SQL})) THEN monthly_rent END")} AS mean_after
FROM t GROUP BY state""")
def contamination(spark: SparkSession, d: str) -> DataFrame:
    """Rows removed by the exclusion and mean rent before/after, per state."""
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    t = j.select(F.col("n_name").alias("state"), F.col("o_totalprice").alias("monthly_rent"),
                 B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY).alias("category_id"))
    return A.contamination(t)


@register("coverage_growth", """WITH b AS (SELECT o_orderstatus AS status, count(*) AS n_before FROM orders
                    WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00' GROUP BY 1),
a AS (SELECT o_orderstatus AS status, count(*) AS n_after FROM orders GROUP BY 1)
SELECT coalesce(b.status, a.status) AS status, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after,
  coalesce(n_after, 0) - coalesce(n_before, 0) AS delta FROM b FULL OUTER JOIN a ON b.status = a.status""")
def coverage_growth(spark: SparkSession, d: str) -> DataFrame:
    """Rows per status in an older snapshot vs the current one."""
    o = read_table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), "o_orderdate")
    before = o.where(F.col("o_orderdate") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    return A.coverage_growth(before, o, ["status"])


@register("run_counters", f"""WITH inc AS (SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
     {B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY)} || ', For rent' AS category_id FROM orders),
new AS (SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = inc.ads_id)),
kept AS (SELECT * FROM new WHERE {Q.strip_category('category_id')} NOT IN ({EXCLUDED_SQL}))
SELECT (SELECT count(*) FROM inc) AS n_in, (SELECT count(*) FROM inc) - (SELECT count(*) FROM new) AS n_skipped,
       (SELECT count(*) FROM new) AS n_new, (SELECT count(*) FROM new) - (SELECT count(*) FROM kept) AS n_excluded,
       (SELECT count(*) FROM kept) AS n_kept""")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """A10: counters of a load run (in, skipped as known, new, excluded, kept) as one row."""
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem")
    inc = o.select(F.col("o_orderkey").cast("string").alias("ads_id"),
                   F.concat(B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY), F.lit(", For rent")).alias("category_id"))
    known = li.select(F.col("l_orderkey").cast("string").alias("known")).distinct()
    marked = inc.join(known, F.col("ads_id") == F.col("known"), "left")
    new = F.col("known").isNull()
    out = new & LF.strip_category("category_id").isin(*K.EXCLUDED_CATEGORIES)
    n = lambda c: F.count(F.when(c, 1))
    return A.run_counters({
        "n_in": F.count(F.lit(1)), "n_skipped": n(~new), "n_new": n(new), "n_excluded": n(out), "n_kept": n(new & ~out),
    }, marked)


@register("clean_job", f"""SELECT l.ads_id, {Q.clean_rent('l.monthly_rent')} AS monthly_rent, {Q.strip_category('l.category_id')} AS category_id,
  {Q.clean_size('l.size')} AS size, {Q.clean_rooms('l.rooms')} AS rooms, {Q.publish_date('l.publishedDatetime')} AS publishedDatetime,
  l.property_type, l.state, {Q.standard_type('l.property_type')} AS CPI
FROM ({B.order_raw_listings_sql()}) l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key
WHERE {Q.strip_category('l.category_id')} NOT IN ({EXCLUDED_SQL})""")
def clean_job(spark: SparkSession, d: str) -> DataFrame:
    """The whole clean step (W1, F1, F5/W2, F2, F3, F4, J2) over raw text listings."""
    return clean_listings(B.order_raw_listings(spark, d), mapping_dimension(spark))


@register("content_dedup_lines", """WITH t AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ads_id,
     l_partkey, l_quantity, l_returnflag, l_extendedprice FROM lineitem)
SELECT ads_id, l_partkey, l_quantity, l_returnflag, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_quantity, l_returnflag ORDER BY ads_id, l_extendedprice) AS rn FROM t)
WHERE rn = 1""")
def content_dedup_lines(spark: SparkSession, d: str) -> DataFrame:
    """D2 on lines: rows equal on (part, quantity, return flag) collapse to the smallest
    text id (ties on the id broken by the smallest remaining values)."""
    li = read_table(spark, d, "lineitem")
    t = li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("ads_id"),
                  "l_partkey", "l_quantity", "l_returnflag", "l_extendedprice")
    return content_dedup(t, ["l_partkey", "l_quantity", "l_returnflag"])


# --------------------------------------------------------------------------- streaming
@register("stream_ingest", f"""SELECT l.ads_id, {Q.clean_rent('l.monthly_rent')} AS monthly_rent, {Q.strip_category('l.category_id')} AS category_id,
  {Q.clean_size('l.size')} AS size, {Q.clean_rooms('l.rooms')} AS rooms, {Q.publish_date('l.publishedDatetime')} AS publishedDatetime,
  l.state, {Q.standard_type('l.property_type')} AS CPI
FROM ({B.event_raw_listings_sql()}) l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key
WHERE {Q.strip_category('l.category_id')} NOT IN ({EXCLUDED_SQL})""")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """S8 + ST1: raw listing CSVs landed per (state, type) slice are cleaned by a file
    stream with a checkpoint; a second run finds nothing new (exactly once)."""
    from letwise.sources.files import write_raw
    from letwise.streaming.jobs import ingest_raw
    src, sink, ck = (scratch_path(spark, n) for n in ("raw", "clean", "ckpt"))
    write_raw(B.event_raw_listings(spark, d), src)
    mapping = mapping_dimension(spark)
    ingest_raw(spark, src, sink, ck, mapping)
    ingest_raw(spark, src, sink, ck, mapping)
    out = spark.read.parquet(sink)
    return out.select("ads_id", "monthly_rent", "category_id", "size", "rooms", "publishedDatetime", "state", "CPI")


@register("stream_upsert", """SELECT ads_id, monthly_rent, state, scrape_date, 'active' AS availability_status FROM (
  SELECT CAST(user_id AS VARCHAR) AS ads_id, value AS monthly_rent, event_type AS state, strftime(ts, '%Y-%m-%d') AS scrape_date,
         row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d') DESC, value DESC, event_type DESC) AS rn
  FROM events) WHERE rn = 1""")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """ST2: per-user sightings arrive as files of mixed days; each micro-batch is upserted
    into the versioned table through foreachBatch. The final table equals the batch
    answer: the latest day's row per user, the greatest of one day."""
    from letwise.sources.snapshot import read_snapshot
    from letwise.streaming.jobs import upsert_stream
    e = read_table(spark, d, "events")
    rows = e.select(F.col("user_id").cast("string").alias("ads_id"), F.col("value").alias("monthly_rent"),
                    F.col("event_type").alias("state"), F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"))
    src, root, ck = (scratch_path(spark, n) for n in ("days", "table", "ckpt"))
    rows.repartition(8, "ads_id", "monthly_rent").write.parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(src)
    upsert_stream(stream, root, ck, writer_id="events")
    t = read_snapshot(spark, root)
    return t.select("ads_id", "monthly_rent", "state", "scrape_date", "availability_status")


_DEDUP_PART = ", ".join(K.CONTENT_DEDUP_COLUMNS)


@register("load_job", f"""WITH l AS ({B.order_load_listings_sql()}),
c AS (SELECT l.ads_id, {Q.clean_rent('l.monthly_rent')} AS monthly_rent, {Q.strip_category('l.category_id')} AS category_id,
        {Q.clean_rooms('l.rooms')} AS rooms, {Q.publish_date('l.publishedDatetime')} AS publishedDatetime,
        l.property_type, l.state, {Q.standard_type('l.property_type')} AS CPI, l.scrape_date,
        CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS bathroom, CAST(NULL AS DOUBLE) AS size,
        CAST(NULL AS VARCHAR) AS address
      FROM l LEFT JOIN {Q.mapping_values()} ON trim(l.property_type) = m.key
      WHERE {Q.strip_category('l.category_id')} NOT IN ({EXCLUDED_SQL})),
d AS (SELECT *, row_number() OVER (PARTITION BY {_DEDUP_PART} ORDER BY ads_id) AS rn FROM c)
SELECT ads_id, monthly_rent, category_id, rooms, publishedDatetime, property_type, state, CPI, scrape_date,
       scrape_date AS first_seen, 'active' AS availability_status FROM d WHERE rn = 1""")
def load_job(spark: SparkSession, d: str) -> DataFrame:
    """S8 -> S3 -> clean -> upsert -> content dedup -> versioned snapshot: raw CSVs landed
    per slice are loaded into an empty table and content duplicates removed."""
    from letwise.plans.pipeline import load_raw
    from letwise.sources.files import write_raw
    from letwise.sources.snapshot import read_snapshot
    raw_dir, root = scratch_path(spark, "raw"), scratch_path(spark, "table")
    write_raw(B.order_load_listings(spark, d), raw_dir)
    load_raw(spark, raw_dir, root, mapping_dimension(spark))
    t = read_snapshot(spark, root)
    return t.select("ads_id", "monthly_rent", "category_id", "rooms", "publishedDatetime", "property_type", "state",
                    "CPI", "scrape_date", ymd("first_seen").alias("first_seen"), "availability_status")


def _day_step_sql(source: str, day: str, outcome: str) -> str:
    """The re-check transition of one day's probes over a table given in SQL."""
    due = Q.due("first_seen", "last_checked_at", "availability_status", day)
    return f"""SELECT ads_id, state, first_seen, ad_expiry, o_orderkey, n_lines,
  CASE WHEN {due} AND {outcome} = 'gone' THEN {Q.classify_gone('ad_expiry', day)} ELSE availability_status END AS availability_status,
  CASE WHEN {due} AND {outcome} IN ('alive', 'gone') THEN {Q.day(day)} ELSE last_checked_at END AS last_checked_at,
  CASE WHEN {due} AND {outcome} = 'gone' THEN {Q.day(day)} ELSE gone_at END AS gone_at FROM ({source})"""


_SECOND_PROBE = "(CASE WHEN o_orderkey % 50 = 0 THEN 'unknown' WHEN n_lines > 0 THEN 'alive' ELSE 'gone' END)"
_TWO_DAYS_SQL = f"""SELECT ads_id, state, availability_status, strftime(last_checked_at, '%Y-%m-%d') AS last_checked_at,
  strftime(gone_at, '%Y-%m-%d') AS gone_at
FROM ({_day_step_sql(_day_step_sql(B.order_table_sql(), '2001-07-14', "'alive'"), '2001-07-15', _SECOND_PROBE)})"""


def _recheck_stream(spark: SparkSession, d: str, files: int | None) -> DataFrame:
    from letwise import schemas as S
    from letwise.sources.snapshot import read_snapshot, write_snapshot
    from letwise.streaming.jobs import recheck_stream
    root, src, ck = (scratch_path(spark, n) for n in ("table", "probes", "ckpt"))
    t = B.order_table(spark, d).select("ads_id", "state", "first_seen", "last_checked_at", "availability_status",
                                       "gone_at", "ad_expiry")
    write_snapshot(t, root)
    log = B.order_probe_log(spark, d).withColumn("day", F.to_date("checked_at"))
    for day in ("2001-07-14", "2001-07-15"):  # landed day by day
        rows = log.where(F.col("day") == day).drop("day")
        # a file a day where a file is a micro-batch: only its rows come to one task, not the joins before it
        (rows.repartition(1) if files else rows).write.mode("append").parquet(src)
    stream = spark.readStream.schema(S.PROBE_SCHEMA)
    stream = stream.option("maxFilesPerTrigger", files) if files else stream
    recheck_stream(stream.parquet(src), root, ck, writer_id="probes")
    out = read_snapshot(spark, root)
    return out.select("ads_id", "state", "availability_status", ymd("last_checked_at").alias("last_checked_at"),
                      ymd("gone_at").alias("gone_at"))


@register("stream_recheck", _TWO_DAYS_SQL)
def stream_recheck(spark: SparkSession, d: str) -> DataFrame:
    """ST4: the probe log arrives as a file stream, all of it in one micro-batch, which drives the
    availability transition on the latest table version; every probe counts on its own day."""
    return _recheck_stream(spark, d, None)


@register("stream_recheck_days", _TWO_DAYS_SQL)
def stream_recheck_days(spark: SparkSession, d: str) -> DataFrame:
    """ST4: the same log, one file a micro-batch; the result is the same."""
    return _recheck_stream(spark, d, 1)
