"""Registered queries of the ingest, load and re-check jobs under rough conditions: reruns, bad files, other
headers, batches cut differently; and of the small operators that ``catalog`` does not reach.

Inputs are made from the test tables as in ``catalog``; a query that lands files writes them first and then runs the
job on the landed folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import constants as K

from letwise.operators import audits as A
from letwise.operators.availability import apply_snapshot, probe_counters, recheck, snapshot_diff
from letwise.operators.clean import build_mapping, category_purge, clean_listings, drop_all_missing, mapping_dimension, standardise_type
from letwise.operators.flatten import item_to_row, stamp_run, variant_to_row
from letwise.operators.geo import lookup_coordinates
from letwise.operators.slices import (
    combine_slices,
    ordered_types,
    select_slices,
    unknown_states,
    with_slice_names,
    write_combined,
)
from letwise.operators.upsert import conform, upsert
from letwise.plans import bindings as B
from letwise.plans import sqlfrag as Q
from letwise.plans.catalog import _DEDUP_PART, EXCLUDED_SQL, _geo_inputs, register, ymd
from letwise.plans.pipeline import full_run, load_processed, load_raw
from letwise.session import scratch_path
from letwise.sources.files import (
    read_geo, read_mapping_csv, read_pages, read_raw_csv, read_table, split_corrupt, variant_items, write_geo, write_raw,
)
from letwise.sources.snapshot import read_snapshot, write_snapshot


# --------------------------------------------------------------------------- load twice
_LOADED_SQL = f"""l AS ({B.order_load_listings_sql()}),
c AS (SELECT l.ads_id, {Q.clean_rent('l.monthly_rent')} AS monthly_rent, {Q.strip_category('l.category_id')} AS category_id,
        {Q.clean_rooms('l.rooms')} AS rooms, {Q.publish_date('l.publishedDatetime')} AS publishedDatetime,
        l.property_type, l.state, l.scrape_date,
        CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS bathroom, CAST(NULL AS DOUBLE) AS size,
        CAST(NULL AS VARCHAR) AS address
      FROM l WHERE {Q.strip_category('l.category_id')} NOT IN ({EXCLUDED_SQL})),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_DEDUP_PART} ORDER BY ads_id) AS rn FROM c) WHERE rn = 1)"""


@register("load_rerun", f"""WITH {_LOADED_SQL}
SELECT ads_id, monthly_rent, scrape_date AS first_seen, '2026-06-10' AS last_checked_at,
  CASE WHEN CAST(ads_id AS BIGINT) % 5 = 0 THEN 'expired' ELSE 'active' END AS availability_status,
  CASE WHEN CAST(ads_id AS BIGINT) % 5 = 0 THEN '2026-06-10' END AS gone_at, 0 AS pulled_again FROM d""")
def load_rerun(spark: SparkSession, d: str) -> DataFrame:
    """S12 + S10: load a folder, re-check the table, load the same folder again. The second load finds no new
    file and the availability history stays."""
    raw_dir, root = scratch_path(spark, "raw"), scratch_path(spark, "table")
    write_raw(B.order_load_listings(spark, d), raw_dir)
    load_raw(spark, raw_dir, root, mapping_dimension(spark))
    table = read_snapshot(spark, root)
    gone = F.when(F.col("ads_id").cast("bigint") % 5 == 0, F.lit("gone")).otherwise(F.lit("alive"))
    write_snapshot(recheck(table, table.select("ads_id", gone.alias("outcome")), "2026-06-10"), root)
    again = load_raw(spark, raw_dir, root, mapping_dimension(spark))
    t = read_snapshot(spark, root)
    return t.select("ads_id", "monthly_rent", ymd("first_seen").alias("first_seen"),
                    ymd("last_checked_at").alias("last_checked_at"), "availability_status", ymd("gone_at").alias("gone_at"),
                    F.lit(again.counters["pulled"]).alias("pulled_again"))


def _lines(frame: DataFrame, header: str, line, path: str) -> None:
    """Land CSV files whose header and lines are given as text, so that lines may be short."""
    (frame.select(line.alias(header)).write.mode("append").option("header", True).option("sep", "\u0001")
     .option("escapeQuotes", False).csv(path))


@register("quarantine_report", f"""WITH o AS (SELECT o_orderkey AS k, {B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY)} AS cat FROM orders),
f AS (SELECT CASE WHEN k % 11 = 0 THEN 'corrupt' WHEN coalesce(cat, '') IN ({EXCLUDED_SQL}) THEN 'excluded'
             WHEN k % 13 = 0 THEN 'blank_key' ELSE 'kept' END AS kind FROM o),
p AS (SELECT CAST(floor(o_orderkey / 200) AS BIGINT) AS page_no, count(*) AS n FROM orders GROUP BY 1)
SELECT 'csv ' || kind AS kind, count(*) AS n FROM f GROUP BY 1
UNION ALL SELECT 'csv pulled', count(*) FROM f
UNION ALL SELECT 'page bad_pages', count(*) FROM p WHERE page_no % 7 = 0
UNION ALL SELECT 'page pulled', coalesce(sum(n), 0) FROM p WHERE page_no % 7 <> 0
UNION ALL SELECT 'table corrupt', count(*) FROM f WHERE kind = 'corrupt'
UNION ALL SELECT 'table blank_key', count(*) FROM f WHERE kind = 'blank_key'
UNION ALL SELECT 'table bad_page', count(*) FROM p WHERE page_no % 7 = 0""")
def quarantine_report(spark: SparkSession, d: str) -> DataFrame:
    """S1 + S11 + W9 + A10: broken pages, short rows and blank keys. Counters of both runs (each adds up to what
    was pulled), and the rows that the quarantine folder holds."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    cat = F.coalesce(F.concat(B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY), F.lit(", For rent")), F.lit(""))
    key = F.when(k % 13 == 0, F.lit("  ")).otherwise(k.cast("string"))
    line = F.when(k % 11 == 0, F.concat(k.cast("string"), F.lit(",short row"))).otherwise(
        F.concat(key, F.lit(',"'), cat, F.lit('",RM '), k.cast("string"), F.lit(" per month,2026-05-01")))
    raw, pages, root = (scratch_path(spark, n) for n in ("raw", "pages", "table"))
    _lines(o, "ads_id,category_id,monthly_rent,scrape_date", line, raw)
    loaded = load_raw(spark, raw, root, mapping_dimension(spark)).counters
    items = o.select(F.floor(k / 200).cast("bigint").alias("page_no"), F.struct(k.alias("id"), F.struct(
        F.concat(F.lit("p"), k.cast("string")).alias("list_id")).alias("attributes")).alias("item"))
    page = items.groupBy("page_no").agg(F.to_json(F.struct(F.collect_list("item").alias("data"))).alias("value"))
    text = F.when(F.col("page_no") % 7 == 0, F.expr("substr(value, 1, length(value) - 5)")).otherwise(F.col("value"))
    page.select(text.alias("value")).write.text(pages)
    geo = spark.range(0).select(F.lit("").alias("query"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    run = full_run(spark, pages, root, geo, mapping_dimension(spark), "2026-05-02").counters
    counted = [(f"csv {x}", loaded[x]) for x in ("corrupt", "excluded", "blank_key", "kept", "pulled")]
    counted += [(f"page {x}", run[x]) for x in ("bad_pages", "pulled")]
    told = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("kind"), F.lit(int(b)).cast("bigint").alias("n"))
                                                     for a, b in counted])).alias("r")).select("r.*").where("n > 0 or kind not like 'csv%'")
    held = [spark.read.parquet(f"{root}/_quarantine/kind={x}").agg(F.lit(f"table {x}").alias("kind"), F.count(F.lit(1)).alias("n"))
            for x in ("corrupt", "blank_key", "bad_page")]
    out = told
    for h in held:
        out = out.unionByName(h)
    return out


# --------------------------------------------------------------------------- headers
_MIXED_SQL = f"""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders),
r AS (SELECT CAST(k AS VARCHAR) AS ads_id, CAST(k AS DOUBLE) AS monthly_rent, CASE WHEN k % 3 = 2 THEN NULL ELSE s END AS state,
        CASE WHEN k % 3 = 1 THEN 'Flat' END AS property_type FROM o WHERE NOT (k % 3 = 2 AND k % 4 = 0))
SELECT 'batch' AS read_by, * FROM r UNION ALL SELECT 'stream', * FROM r"""


@register("csv_mixed_headers", _MIXED_SQL)
def csv_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    """S3 + S4 + S11 + ST1: files with their columns in three orders, one with an unknown column, one processed (with
    CPI), one with short rows; read by name, the same in batch and stream."""
    from letwise.streaming.jobs import ingest_raw
    o = read_table(spark, d, "orders")
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    src, sink, ck = (scratch_path(spark, n) for n in ("raw", "clean", "ckpt"))
    rent = F.concat(F.lit("RM "), text, F.lit(" per month"))
    _lines(o.where(k % 3 == 0), "state,extra,ads_id,monthly_rent", F.concat_ws(",", "o_orderstatus", F.lit("x"), text, rent), src)
    _lines(o.where(k % 3 == 1), "CPI,monthly_rent,property_type,ads_id,state",
           F.concat_ws(",", F.lit("Apartment"), rent, F.lit("Flat"), text, "o_orderstatus"), src)
    _lines(o.where(k % 3 == 2), "ads_id,monthly_rent", F.when(k % 4 == 0, text).otherwise(F.concat_ws(",", text, rent)), src)
    good, _ = split_corrupt(read_raw_csv(spark, src))
    batch = clean_listings(good.drop("source_file", "CPI"), None, drop_empty_rows=False)
    ingest_raw(spark, src, sink, ck, max_files_per_trigger=2)
    columns = ["ads_id", "monthly_rent", "state", "property_type"]
    return (batch.select(F.lit("batch").alias("read_by"), *columns)
            .unionByName(spark.read.parquet(sink).select(F.lit("stream").alias("read_by"), *columns)))


@register("load_processed", f"""WITH {_LOADED_SQL}
SELECT d.ads_id, d.monthly_rent, d.category_id, d.publishedDatetime, {Q.standard_type('d.property_type')} AS CPI
FROM d LEFT JOIN {Q.mapping_values()} ON trim(d.property_type) = m.key""")
def load_processed_q(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned listings written as processed CSV (with CPI) and loaded without cleaning them again."""
    folder, root = scratch_path(spark, "processed"), scratch_path(spark, "table")
    cleaned = clean_listings(B.order_load_listings(spark, d), mapping_dimension(spark))
    cleaned.write.option("header", True).option("escape", '"').csv(folder)
    load_processed(spark, folder, root)
    return read_snapshot(spark, root).select("ads_id", "monthly_rent", F.coalesce("category_id", F.lit("")).alias("category_id"),
                                             F.coalesce("publishedDatetime", F.lit("")).alias("publishedDatetime"), "CPI")


# --------------------------------------------------------------------------- same-day order
@register("upsert_same_day", """WITH r AS (SELECT CAST(user_id AS VARCHAR) AS ads_id, value AS monthly_rent, strftime(ts, '%Y-%m-%d') AS scrape_date,
  'f' || CAST(event_id % 7 AS VARCHAR) || '#' || lpad(CAST(event_id AS VARCHAR), 20, '0') AS load_key FROM events),
w AS (SELECT ads_id, monthly_rent, scrape_date, load_key, min(scrape_date) OVER (PARTITION BY ads_id) AS first_seen,
        row_number() OVER (PARTITION BY ads_id ORDER BY scrape_date DESC, load_key DESC) AS rn FROM r),
x AS (SELECT ads_id, monthly_rent, scrape_date, load_key, first_seen,
        CASE WHEN scrape_date > first_seen THEN scrape_date END AS last_checked_at FROM w WHERE rn = 1)
SELECT 'one batch' AS cut, * FROM x UNION ALL SELECT 'two batches', ads_id, monthly_rent, scrape_date, load_key, NULL, NULL FROM x""")
def upsert_same_day(spark: SparkSession, d: str) -> DataFrame:
    """M1 + T11: several sightings a day from several files: the last file, then position, wins, in one batch as in
    two that cut the days across, loaded in the wrong order and the first one twice."""
    e = read_table(spark, d, "events")
    rows = e.select(F.col("user_id").cast("string").alias("ads_id"), F.col("value").alias("monthly_rent"),
                    F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"),
                    F.concat(F.lit("f"), (F.col("event_id") % 7).cast("string"), F.lit("#"),
                             F.lpad(F.col("event_id").cast("string"), 20, "0")).alias("load_key"))
    odd = F.substring("load_key", -1, 1).cast("int") % 2 == 1
    columns = ["ads_id", "monthly_rent", "scrape_date", "load_key"]
    one = upsert(None, rows).select(F.lit("one batch").alias("cut"), *columns, ymd("first_seen").alias("first_seen"),
                                    ymd("last_checked_at").alias("last_checked_at"))
    two = upsert(upsert(upsert(None, rows.where(odd)), rows.where(~odd)), rows.where(odd))
    none = F.lit(None).cast("string")
    return one.unionByName(two.select(F.lit("two batches").alias("cut"), *columns, none.alias("first_seen"), none.alias("last_checked_at")))


# --------------------------------------------------------------------------- rents
_OUTLIER = "CASE WHEN o_orderkey % 97 = 0 THEN 1e30 WHEN o_orderkey % 89 = 0 THEN 1e18 WHEN o_orderkey % 5 = 0 THEN 0.004 WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END"


@register("rent_outliers", f"""SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS state, count(*) AS n_listings, count(x) AS n_rent,
  CAST(CAST(sum(CASE WHEN x < 1e15 THEN CAST(x AS DECIMAL(38,8)) WHEN x < 1e24 THEN CAST(CAST(x AS HUGEINT) AS DECIMAL(38,8)) END) AS VARCHAR) AS DOUBLE) / count(CASE WHEN x < 1e24 THEN 1 END) AS mean_rent,
  median(x) AS median_rent, count(CASE WHEN x >= 1e24 THEN 1 END) AS n_left_out
FROM (SELECT *, CAST({_OUTLIER} AS DOUBLE) AS x FROM orders) GROUP BY 1""")
def rent_outliers(spark: SparkSession, d: str) -> DataFrame:
    """A1: rents of many decimals, huge rents, and rents too large for the exact mean, which are counted."""
    o = read_table(spark, d, "orders")
    state = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return A.rent_summary(o.select(state.alias("state"), F.expr(_OUTLIER).cast("double").alias("monthly_rent")), left_out=True)


# --------------------------------------------------------------------------- snapshot diff applied
_PULL_SQL = """t AS (SELECT CAST(c_custkey AS VARCHAR) AS ads_id, c_custkey % 3 AS s, c_custkey % 5 AS y, c_custkey AS k FROM customer),
r AS (SELECT t.*, CASE WHEN s = 1 AND y = 2 THEN k % 2 = 0 WHEN s = 2 AND y = 3 THEN FALSE ELSE TRUE END AS pulled,
        k % 4 = 0 AS left_market FROM t),
done AS (SELECT s, y FROM r GROUP BY s, y HAVING count(CASE WHEN pulled AND NOT left_market THEN 1 END) >= count(CASE WHEN NOT left_market THEN 1 END)
          AND count(CASE WHEN NOT left_market THEN 1 END) > 0)"""


@register("snapshot_apply", f"""WITH {_PULL_SQL}
SELECT ads_id, CASE WHEN pulled AND NOT left_market THEN '2026-06-01' ELSE '2026-05-20' END AS last_checked_at,
  CASE WHEN pulled AND NOT left_market THEN FALSE WHEN (s, y) IN (SELECT (s, y) FROM done) THEN TRUE ELSE FALSE END AS to_probe FROM r""")
def snapshot_apply(spark: SparkSession, d: str) -> DataFrame:
    """J8 + U2: a fresh pull in which one (state, type) slice came half and one not at all. Present listings get
    the new check date, absent ones of complete slices are to be probed, all others stay."""
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    state, kind = F.concat(F.lit("s"), (k % 3).cast("string")), (k % 5).cast("string")
    table = c.select(k.cast("string").alias("ads_id"), state.alias("state"), kind.alias("property_type_id"),
                     F.to_date(F.lit("2026-05-20")).alias("last_checked_at"), F.lit("active").alias("availability_status"),
                     F.lit(None).cast("string").alias("ad_expiry"), k)
    market = table.where(k % 4 != 0)
    lost = ((F.col("state") == "s1") & (F.col("property_type_id") == "2") & (k % 2 != 0)) | \
        ((F.col("state") == "s2") & (F.col("property_type_id") == "3"))
    fresh = market.where(~lost)
    slices = ["state", "property_type_id"]
    reported = market.groupBy(*slices).agg(F.count(F.lit(1)).alias("total_results"))
    done = A.completed_slices(A.slice_coverage(reported, fresh, slices, depth_cap=1 << 60))
    moved, probes = apply_snapshot(table.drop("c_custkey"), snapshot_diff(table, fresh, done), "2026-06-01")
    probes = probes.select(F.col("ads_id").alias("probe_id"))
    return moved.join(probes, F.col("ads_id") == F.col("probe_id"), "left").select(
        "ads_id", ymd("last_checked_at").alias("last_checked_at"), F.col("probe_id").isNotNull().alias("to_probe"))


@register("recheck_counters", """SELECT '2001-07-14' AS day, count(*) AS n_alive, 0 AS n_gone, 0 AS n_failed FROM orders
UNION ALL
SELECT '2001-07-15', count(CASE WHEN k % 50 <> 0 AND n > 0 THEN 1 END), count(CASE WHEN k % 50 <> 0 AND n = 0 THEN 1 END), count(CASE WHEN k % 50 = 0 THEN 1 END)
FROM (SELECT o_orderkey AS k, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)""")
def recheck_counters(spark: SparkSession, d: str) -> DataFrame:
    """A10 of the re-check: alive, gone and failed probes per day."""
    return probe_counters(B.order_probe_log(spark, d)).withColumn("day", ymd("day"))


# --------------------------------------------------------------------------- lookups
@register("geo_lookup", """WITH g AS (SELECT n_name || ', ' || r_name || ', Malaysia' AS query,
  CASE WHEN n_nationkey % 6 <> 0 THEN CAST(1 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.2 AS DOUBLE) END AS lat,
  CASE WHEN n_nationkey % 6 <> 0 THEN CAST(100 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS lon
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0 OR n_nationkey % 6 = 0)
SELECT CAST(c_custkey AS VARCHAR) AS ads_id, lat AS latitude, lon AS longitude
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN g ON g.query = CASE WHEN c_custkey % 9 = 0 THEN '' ELSE n_name || ', ' || r_name || ', Malaysia' END""")
def geo_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates of a query text; the coordinate table repeats its queries, rows stay one to one."""
    _, geo = _geo_inputs(spark, d)
    c, n, r = (read_table(spark, d, x) for x in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    asked = j.select(k.cast("string").alias("ads_id"), F.when(k % 9 == 0, F.lit("")).otherwise(
        F.concat_ws(", ", "n_name", "r_name", F.lit(K.COUNTRY))).alias("geo_query"))
    return lookup_coordinates(asked, "geo_query", geo).drop("geo_query")


@register("geo_table", """SELECT p_type AS query, max(CAST(p_size AS DOUBLE)) AS lat, max(CAST(p_size AS DOUBLE)) + 100 AS lon FROM part GROUP BY p_type""")
def geo_table(spark: SparkSession, d: str) -> DataFrame:
    """The coordinate table written with one row per query and read back."""
    p = read_table(spark, d, "part")
    path = scratch_path(spark, "geo")
    size = F.col("p_size").cast("double")
    write_geo(p.select(F.col("p_type").alias("query"), size.alias("lat"), (size + 100).alias("lon")), path)
    return read_geo(spark, path)


@register("mapping_csv", """WITH m AS (SELECT n_nationkey AS row, CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE n_name END AS std, n_name, r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT row, std, trim(n_name) AS key FROM m WHERE std IS NOT NULL AND row % 5 <> 4
      UNION ALL SELECT row, std, trim(r_name) FROM m WHERE std IS NOT NULL AND row % 5 <> 4)
SELECT CAST(c_custkey AS VARCHAR) AS ads_id, coalesce(s.std, 'Other') AS CPI
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT key, max_by(std, row) AS std FROM p GROUP BY key) s ON s.key = CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE r_name END""")
def mapping_csv(spark: SparkSession, d: str) -> DataFrame:
    """S5 + F10 + W6 + J2: a mapping CSV with several names in a cell, repeated names (the last row wins), blank lines
    and missing fields, applied to raw types."""
    n, r, c = (read_table(spark, d, x) for x in ("nation", "region", "customer"))
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("n_nationkey")
    cell = F.when(k % 5 != 4, F.concat(F.col("n_name"), F.lit("\n \n  "), F.col("r_name"), F.lit(" ")))
    path = scratch_path(spark, "mapping")
    (j.select(k, cell.alias("Raw"), F.when(k % 7 != 3, F.col("n_name")).alias("Standard")).coalesce(1).sortWithinPartitions("n_nationkey")
     .select("Raw", "Standard").write.option("header", True).option("quoteAll", True).option("nullValue", "").option("emptyValue", "").csv(path))
    mapping = build_mapping(read_mapping_csv(spark, path), "_row")
    places = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    raw = places.select(F.col("c_custkey").cast("string").alias("ads_id"),
                        F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.lit(" "), F.col("r_name"))).alias("property_type"))
    return standardise_type(raw, mapping).select("ads_id", "CPI")


# --------------------------------------------------------------------------- rows
@register("missing_values", """SELECT CAST(p_partkey AS VARCHAR) AS ads_id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS monthly_rent,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS state, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size
FROM part WHERE p_partkey % 10 <> 0""")
def missing_values(spark: SparkSession, d: str) -> DataFrame:
    """W1 + P10 + P9: rows of which every field is missing go; NaN numbers and number texts become NULL."""
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    gone = k % 10 == 0
    raw = p.select(F.when(gone, F.lit("NA")).otherwise(k.cast("string")).alias("ads_id"),
                   F.when(gone, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("nan")).otherwise(F.col("p_retailprice").cast("string")).alias("monthly_rent"),
                   F.when(gone, F.lit("NULL")).when(k % 3 != 0, F.col("p_brand")).alias("state"),
                   F.when(gone, F.lit("")).when(k % 11 == 0, F.lit("NaN")).otherwise(F.col("p_size").cast("string")).alias("size"))
    kept = drop_all_missing(raw, ["ads_id", "monthly_rent", "state", "size"])
    kept = kept.withColumn("size", F.col("size").cast("double"))  # NaN as a number
    return conform(kept).select("ads_id", "monthly_rent", "state", "size")


@register("slice_select", """SELECT ads_id, state, property_type_id FROM (SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderpriority AS state,
  CAST(o_orderkey % 6 AS VARCHAR) AS property_type_id FROM orders) WHERE state IN ('1-URGENT', '5-LOW') AND property_type_id IN ('2', '4')""")
def slice_select(spark: SparkSession, d: str) -> DataFrame:
    """Some states, in any case and spacing, and some types."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ads_id"), F.col("o_orderpriority").alias("state"),
                                              (F.col("o_orderkey") % 6).cast("string").alias("property_type_id"))
    return select_slices(o, states=[" 1-urgent", "5-Low "], type_ids=[2, 4])


@register("state_check", f"""SELECT DISTINCT lower(trim(CASE WHEN c_custkey % 4 = 0 THEN ' Johor ' ELSE n_name END)) AS state_key
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE lower(trim(CASE WHEN c_custkey % 4 = 0 THEN ' Johor ' ELSE n_name END)) NOT IN ({Q.in_list(sorted(K.REGION_CODES))})""")
def state_check(spark: SparkSession, d: str) -> DataFrame:
    """Every state key that the region table does not know."""
    c, n = read_table(spark, d, "customer"), read_table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return unknown_states(j.select(F.when(F.col("c_custkey") % 4 == 0, F.lit(" Johor ")).otherwise(F.col("n_name")).alias("state")))


@register("category_purge", f"""SELECT ads_id, category_id FROM (SELECT CAST(o_orderkey AS VARCHAR) AS ads_id,
  {B.case_sql('o_orderpriority', B.PRIORITY_CATEGORY)} AS category_id FROM orders) WHERE category_id IS NULL OR category_id NOT IN ({EXCLUDED_SQL})""")
def category_purge_q(spark: SparkSession, d: str) -> DataFrame:
    """M6: stored rows of excluded categories go, NULL categories stay."""
    o = read_table(spark, d, "orders")
    return category_purge(o.select(F.col("o_orderkey").cast("string").alias("ads_id"),
                                   B.case_col(F.col("o_orderpriority"), B.PRIORITY_CATEGORY).alias("category_id")))


@register("slice_order", """SELECT p_size AS type_id, min(p_type) AS type_name, CAST(row_number() OVER (ORDER BY p_size) AS INTEGER) AS place FROM part GROUP BY p_size""")
def slice_order(spark: SparkSession, d: str) -> DataFrame:
    """L2: the types seen, one row each, in the order in which their slices run."""
    types = read_table(spark, d, "part").groupBy(F.col("p_size").alias("type_id")).agg(F.min("p_type").alias("type_name"))
    return ordered_types(types)


_STATE_OF = sorted(K.REGION_CODES)
_SLICE_SQL = f"""WITH st(i, state_key, region_code) AS (VALUES {", ".join(f"({i}, '{s}', '{K.REGION_CODES[s]}')" for i, s in enumerate(_STATE_OF))}),
ty(type_id, type_name) AS (VALUES {", ".join(f"({i}, '{n}')" for i, n in sorted(K.RESIDENTIAL_PROPERTY_TYPE_IDS.items()))})
SELECT st.region_code, ty.type_name, count(*) AS listings FROM lineitem
LEFT JOIN st ON l_suppkey % 20 = st.i LEFT JOIN ty ON l_partkey % 60 = ty.type_id GROUP BY 1, 2"""


@register("slice_names", _SLICE_SQL)
def slice_names(spark: SparkSession, d: str) -> DataFrame:
    """J9, both sides: listings counted by region code and type name of their slice; unknown states and types are
    groups of their own."""
    states = F.create_map(*[x for i, s in enumerate(_STATE_OF) for x in (F.lit(i), F.lit(f" {s.title()} "))])
    rows = read_table(spark, d, "lineitem").select(
        F.coalesce(states[(F.col("l_suppkey") % 20).cast("int")], F.lit("elsewhere")).alias("state"),
        (F.col("l_partkey") % 60).cast("string").alias("property_type_id"))
    return with_slice_names(rows).groupBy("region_code", "type_name").agg(F.count(F.lit(1)).alias("listings"))


@register("slice_totals", """WITH s AS (SELECT r_name AS region, n_name AS slice, count(c_custkey) AS reported FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN customer ON c_nationkey = n_nationkey AND NOT (c_nationkey % 5 = 0) GROUP BY 1, 2),
t AS (SELECT *, sum(reported) OVER (PARTITION BY region) AS region_total, count(*) OVER (PARTITION BY region) AS n FROM s)
SELECT region, slice, reported, CAST(region_total AS BIGINT) AS region_total, reported > 0 AND (reported < region_total OR n = 1) AS sane FROM t""")
def slice_totals(spark: SparkSession, d: str) -> DataFrame:
    """A slice's total is above 0 and below its region's."""
    c, n, r = (read_table(spark, d, x) for x in ("customer", "nation", "region"))
    places = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("slice"))
    j = places.join(c.where(F.col("c_nationkey") % 5 != 0), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    totals = j.groupBy("region", "slice").agg(F.count("c_custkey").alias("reported"))
    return A.slice_totals(totals, ["region"]).drop("region_slices")


@register("combined_snapshot", """SELECT ads_id, state, slice_no FROM (SELECT *, row_number() OVER (PARTITION BY ads_id ORDER BY slice_no) AS rn FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS ads_id, o_orderpriority AS state, 0 AS slice_no FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 1 FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 3 = 0)) WHERE rn = 1""")
def combined_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping slices combined, written per state and read back."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ads_id"), F.col("o_orderpriority").alias("state"),
                                              "o_orderstatus", "o_orderkey")
    path = scratch_path(spark, "combined")
    write_combined(combine_slices([o.where("o_orderstatus = 'F'").select("ads_id", "state"),
                                   o.where("o_orderstatus <> 'F' or o_orderkey % 3 = 0").select("ads_id", "state")]), path)
    return spark.read.parquet(path).select("ads_id", "state", "slice_no")


_PAGE_SQL = {
    "ads_id": "k", "monthly_rent": "CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'RM ' || k || ' per month' END",
    "property_type": "'Flat, ' || o_orderstatus", "property_type_id": "CAST(o_orderkey % 7 AS VARCHAR)", "category_id": "'Room, For rent'",
    "state": "o_orderpriority", "region": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'R' || k END", "subarea_id": "CAST(o_orderkey % 3 AS VARCHAR)",
    "rooms": "'3'", "bathroom": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '2' END", "size": "CASE WHEN k = '0' THEN '' ELSE k || ' sq.ft.' END",
    "address": "CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE 'R' || k || ', ' || o_orderpriority END", "seller_name": "o_clerk",
    "company_ad": "'1'", "ad_seller_type": "'agent'", "store_verified": "'a, b'", "ad_expiry": "'2026-09-01 00:00:00'",
    "publishedDatetime": "strftime(o_orderdate, '%Y-%m-%d')", "adviewUrl": "'u/' || k", "scrape_date": "'2026-05-03'",
}


_PAGES_SQL = ("SELECT " + ", ".join(f"{e} AS {c}" for c, e in _PAGE_SQL.items()) +
              " FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k, 'C' || CAST(o_custkey AS VARCHAR) AS o_clerk FROM orders)")


def landed_pages(spark: SparkSession, d: str) -> str:
    """A folder of search pages whose items hold every attribute, some as lists."""
    o = read_table(spark, d, "orders")
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    attrs = F.struct(
        text.alias("list_id"), F.when(k % 10 != 0, F.concat(F.lit("RM "), text)).alias("price_label"),
        F.array(F.lit("Flat"), F.col("o_orderstatus")).alias("property_type_name"), (k % 7).alias("property_type_id"),
        F.lit("Room").alias("category_name"), F.col("o_orderpriority").alias("region_name"),
        F.when(k % 4 != 0, F.concat(F.lit("R"), text)).alias("subarea_name"), (k % 3).alias("subarea_id"),
        F.lit(3).alias("rooms_name"), F.when(k % 5 != 0, F.lit("2")).alias("bathroom_name"), text.alias("size"),
        F.lit("sq.ft.").alias("size_suffix"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("name"),
        F.lit("1").alias("company_ad"), F.lit("agent").alias("ad_seller_type"), F.array(F.lit("a"), F.lit("b")).alias("store_verified"),
        F.lit("2026-09-01 00:00:00").alias("ad_expiry"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("u/"), text).alias("adview_url"))
    items = o.select(F.floor(k / K.PAGE_SIZE).alias("page_no"), F.struct(k.alias("id"), attrs.alias("attributes")).alias("item"))
    path = scratch_path(spark, "pages")
    items.groupBy("page_no").agg(F.to_json(F.struct(F.collect_list("item").alias("data"))).alias("value")).select("value").write.text(path)
    return path


@register("page_flatten_all", _PAGES_SQL)
def page_flatten_all(spark: SparkSession, d: str) -> DataFrame:
    """P1 + P2 + P7: all 19 listing fields of landed pages, lists among them, stamped with the run date."""
    return stamp_run(item_to_row(read_pages(spark, landed_pages(spark, d))), "2026-05-03").select(*_PAGE_SQL)


@register("page_variants", _PAGES_SQL)
def page_variants(spark: SparkSession, d: str) -> DataFrame:
    """S1 + P1 + P2: the same pages through Variant items."""
    items, _ = variant_items(spark, landed_pages(spark, d))
    return stamp_run(variant_to_row(items), "2026-05-03").select(*_PAGE_SQL)


@register("stream_sightings", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS ads_id FROM events")
def stream_sightings(spark: SparkSession, d: str) -> DataFrame:
    """ST3: sightings arrive as files; within the watermark each listing is passed on once."""
    from letwise.streaming.jobs import dedup_sightings
    src, sink, ck = (scratch_path(spark, n) for n in ("sightings", "first", "ckpt"))
    e = read_table(spark, d, "events").select(F.col("user_id").cast("string").alias("ads_id"), F.col("ts").cast("timestamp").alias("seen_at"))
    e.repartition(4, "seen_at").write.parquet(src)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(src)
    (dedup_sightings(stream, delay="3650 days").writeStream.format("parquet").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(sink).awaitTermination())
    return spark.read.parquet(sink).select("ads_id")


@register("stream_sightings_again", """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS ads_id, event_id % 5 AS slot FROM events),
w AS (SELECT ads_id, bool_or(slot = 0) AS d1, bool_or(slot = 1) AS d2, bool_or(slot = 2) AS d20, bool_or(slot = 3) AS d21 FROM e GROUP BY ads_id)
SELECT ads_id, '2026-01-01' AS passed FROM w WHERE d1 UNION ALL SELECT ads_id, '2026-01-02' FROM w WHERE d2 AND NOT d1
UNION ALL SELECT ads_id, '2026-01-20' FROM w WHERE d20 UNION ALL SELECT ads_id, '2026-01-21' FROM w WHERE d21 AND NOT d20""")
def stream_sightings_again(spark: SparkSession, d: str) -> DataFrame:
    """ST3 with eviction: within two days a listing passes once; a sighting after the watermark has passed its first one
    passes again; a late one, behind the watermark, is dropped. Sightings land day by day, a file a micro-batch."""
    from letwise.streaming.jobs import dedup_sightings
    src, sink, ck = (scratch_path(spark, n) for n in ("sightings", "first", "ckpt"))
    day = F.create_map(*[x for i, t in enumerate(("2026-01-01", "2026-01-02", "2026-01-20", "2026-01-21", "2026-01-03")) for x in (F.lit(i), F.lit(t))])
    e = read_table(spark, d, "events").select(F.col("user_id").cast("string").alias("ads_id"), (F.col("event_id") % 5).cast("int").alias("slot"),
                                              (F.col("event_id") % 36000).alias("second"))
    at = F.to_timestamp(day[F.col("slot")]) + F.make_dt_interval(secs=F.col("second"))
    seen = e.select("ads_id", at.alias("seen_at"), "slot")
    # two days of other listings let the watermark pass the first ones before they come again
    marks = [spark.range(1).select(F.lit(f"mark {x}").alias("ads_id"), F.to_timestamp(F.lit(x)).alias("seen_at")) for x in ("2026-01-15", "2026-01-16")]
    days = [seen.where(f"slot = {i}").drop("slot") for i in (0, 1, 2, 3, 4)]
    for frame in (days[0], days[1], *marks, days[2], days[3], days[4]):
        frame.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("ads_id string, seen_at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    (dedup_sightings(stream, delay="2 days").writeStream.format("parquet").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(sink).awaitTermination())
    return spark.read.parquet(sink).where(~F.col("ads_id").startswith("mark")).select("ads_id", F.date_format("seen_at", "yyyy-MM-dd").alias("passed"))
