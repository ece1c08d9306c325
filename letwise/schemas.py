"""Schemas of the listing data model.

The fact table is keyed on ``ads_id``. Its columns fall in two ownership classes:
*scrape columns* (overwritten by every upsert) and *re-check columns* (owned by the
availability pass and protected from the upsert).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
DT = T.DateType()

# Scrape columns in table order (the key first).
SCRAPE_FIELDS = [
    ("ads_id", S),
    ("monthly_rent", D),
    ("property_type", S),
    ("property_type_id", S),
    ("category_id", S),
    ("CPI", S),
    ("state", S),
    ("region", S),
    ("subarea_id", S),
    ("rooms", S),
    ("bathroom", S),
    ("size", D),
    ("address", S),
    ("seller_name", S),
    ("company_ad", S),
    ("ad_seller_type", S),
    ("store_verified", S),
    ("ad_expiry", S),
    ("latitude", D),
    ("longitude", D),
    ("publishedDatetime", S),
    ("scrape_date", S),
    ("adviewUrl", S),
    # file and position a row was loaded from; decides between rows of one key and scrape date
    ("load_key", S),
]

# Re-check columns, protected from the upsert.
RECHECK_FIELDS = [
    ("first_seen", DT),
    ("last_checked_at", DT),
    ("availability_status", S),
    ("gone_at", DT),
]

SCRAPE_COLUMNS = [n for n, _ in SCRAPE_FIELDS]
RECHECK_COLUMNS = [n for n, _ in RECHECK_FIELDS]
TABLE_COLUMNS = SCRAPE_COLUMNS + RECHECK_COLUMNS
KEY = "ads_id"

TABLE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in SCRAPE_FIELDS + RECHECK_FIELDS])
TABLE_TYPES = {n: t for n, t in SCRAPE_FIELDS + RECHECK_FIELDS}

# Flat listing row produced from a page item (all text, as landed in raw CSV).
RAW_COLUMNS = [
    "ads_id", "monthly_rent", "property_type", "property_type_id", "category_id", "state",
    "region", "subarea_id", "rooms", "bathroom", "size", "address", "seller_name",
    "company_ad", "ad_seller_type", "store_verified", "ad_expiry", "publishedDatetime",
    "adviewUrl", "scrape_date", "latitude", "longitude",
]
RAW_SCHEMA = T.StructType([T.StructField(n, S, True) for n in RAW_COLUMNS])

# Attributes of one listing item on a search page. Every attribute is read as text:
# a scalar arrives as its text, a JSON array as its JSON text.
ITEM_ATTRIBUTES = [
    "list_id", "price_label", "monthly_rent", "property_type_name", "property_type_id",
    "category_name", "region_name", "subarea_name", "subarea_id", "building_name",
    "rooms_name", "bathroom_name", "size", "size_suffix", "name", "company_ad",
    "ad_seller_type", "store_verified", "ad_expiry", "published_date", "date", "adview_url",
]
ATTRIBUTES_SCHEMA = T.StructType([T.StructField(n, S, True) for n in ITEM_ATTRIBUTES])
ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("attributes", ATTRIBUTES_SCHEMA, True),
])
PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(ITEM_SCHEMA, True), True),
    T.StructField("meta", T.StructType([
        T.StructField("total-results", T.LongType(), True),
        T.StructField("total-showing", T.LongType(), True),
    ]), True),
])

# Probe log of single-listing lookups: one row per probe.
PROBE_SCHEMA = T.StructType([
    T.StructField("ads_id", S, True),
    T.StructField("checked_at", T.TimestampType(), True),
    T.StructField("http_ok", T.BooleanType(), True),
    T.StructField("n_items", T.LongType(), True),
])

# Coordinate lookup table: one row per query text. A null pair is a cached miss.
GEO_SCHEMA = T.StructType([
    T.StructField("query", S, False),
    T.StructField("lat", D, True),
    T.StructField("lon", D, True),
])

# Type mapping dimension: raw type text (may hold several names separated by
# newlines) -> standard type. Its CSV is read positionally: first column raw, second std.
MAPPING_SCHEMA = T.StructType([
    T.StructField("raw", S, True),
    T.StructField("std", S, True),
])
