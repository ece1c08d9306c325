"""Registered queries of the tables that are kept between loads: by state, by bucket.

Inputs are made from the test tables as in ``catalog``; the jobs run on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import schemas as S
from letwise.operators.clean import mapping_dimension
from letwise.plans import bindings as B
from letwise.plans import sqlfrag as Q
from letwise.plans.catalog import (
    _SECOND_PROBE, _TWO_DAYS_SQL, _UPSERT_SQL, EXCLUDED_SQL, _day_step_sql, register, upsert_inputs, ymd,
)
from letwise.plans.state_load import merge_states
from letwise.session import scratch_path
from letwise.sources.buckets import create, merge_buckets, read_buckets
from letwise.sources.files import list_csv, read_table, write_raw
from letwise.sources.lookups import append_lookups, compact_lookups, open_queries, outcome, read_lookups, with_coordinates
from letwise.sources.states import overwrite_parts, read_states, to_stored
from letwise.streaming.expiry import apply_changes, track_availability
from letwise.streaming.jobs import RECHECKS, load_stream, read_counters, recheck_states_stream

# --------------------------------------------------------------------------- four loads by state
_LOADS = [
    # rows, state, rent, scrape date
    ("o_orderkey % 3 <> 2", "o_orderstatus", "rent", "2026-05-01"),
    ("o_orderkey % 4 = 0", "translate(o_orderstatus, 'FOP', 'OPF')", "rent", "2026-05-08"),
    ("o_orderkey % 3 = 2 OR o_orderkey % 5 = 0", "o_orderstatus", "rent + o_orderkey % 2 * 1000", "2026-05-15"),
    ("o_orderkey % 7 = 0 AND o_orderkey % 4 <> 0 AND o_orderstatus IN ('F', 'O')", "o_orderstatus", "rent", "2026-05-22"),
]
_CONTENT = "monthly_rent, property_type, state, rooms, publishedDatetime"


def _loads_sql(given: str, batches: list[str], more: str) -> str:
    """Every load: upsert by key, then the full content rule over the whole table. ``given`` are CTEs, ``batches`` select
    the columns of ``_BATCH`` from them, ``more`` are further columns of the result."""
    parts = [given, "t0 AS (SELECT '' AS ads_id, CAST(0 AS DOUBLE) AS monthly_rent, '' AS state, '' AS rooms, '' AS property_type, "
             "'' AS publishedDatetime, '' AS scrape_date, '' AS first_seen, '' AS last_checked_at WHERE FALSE)"]
    for i, batch in enumerate(batches, 1):
        parts.append(f"b{i} AS ({batch})")
        parts.append(f"""m{i} AS (SELECT b.*, coalesce(t.first_seen, b.scrape_date) AS first_seen, CASE WHEN t.ads_id IS NOT NULL THEN b.scrape_date END AS last_checked_at
  FROM b{i} b LEFT JOIN t{i - 1} t ON b.ads_id = t.ads_id UNION ALL SELECT t.* FROM t{i - 1} t WHERE t.ads_id NOT IN (SELECT ads_id FROM b{i}))""")
        parts.append(f"t{i} AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {_CONTENT} ORDER BY ads_id) AS rn FROM m{i}) WHERE rn = 1)")
    return f"WITH {', '.join(parts)} SELECT * EXCLUDE (property_type, publishedDatetime), 'active' AS availability_status, {more} FROM t{len(batches)}"


def _load_sql() -> str:
    given = """o AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS ads_id, floor(o_totalprice / 100000) * 1000 AS rent, CAST(o_orderkey % 3 AS VARCHAR) AS rooms,
  CAST(o_orderkey % 7 AS VARCHAR) AS property_type, strftime(o_orderdate, '%Y-01-01') AS publishedDatetime FROM orders)"""
    return _loads_sql(given, [f"SELECT ads_id, CAST({rent} AS DOUBLE) AS monthly_rent, {state} AS state, rooms, property_type, publishedDatetime, '{day}' AS scrape_date FROM o WHERE {rows}"
                              for rows, state, rent, day in _LOADS], "'f,o' AS last_parts")


@register("load_by_state", _load_sql())
def load_by_state(spark: SparkSession, d: str) -> DataFrame:
    """S7 + M1 + M5: four loads into the table by state: new listings, listings that change state, new content for old
    listings, and a batch of two states, which rewrites these two folders alone. Equal to the full upsert and the full
    content rule after each load."""
    o = read_table(spark, d, "orders")
    o = o.withColumns({"rent": F.floor(F.col("o_totalprice") / 100000) * 1000, "rooms": (F.col("o_orderkey") % 3).cast("string"),
                       "property_type": (F.col("o_orderkey") % 7).cast("string"), "publishedDatetime": F.date_format("o_orderdate", "yyyy-01-01")})
    root, done = scratch_path(spark, "by-state"), {}
    for rows, state, rent, day in _LOADS:
        batch = o.where(rows).select(F.col("o_orderkey").cast("string").alias("ads_id"), F.expr(rent).cast("double").alias("monthly_rent"),
                                     F.expr(state).alias("state"), "rooms", "property_type", "publishedDatetime", F.lit(day).alias("scrape_date"))
        done = merge_states(spark, batch, root)
    return read_states(spark, root).select("ads_id", "monthly_rent", "state", "rooms", "scrape_date", ymd("first_seen").alias("first_seen"),
                                           ymd("last_checked_at").alias("last_checked_at"), "availability_status",
                                           F.lit(",".join(done["parts"])).alias("last_parts"))


# --------------------------------------------------------------------------- one exchange
@register("upsert_bucketed", _UPSERT_SQL)
def upsert_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """J7 + R2 + M1: the ``upsert`` query on a bucketed table: only the batch is exchanged, and the next version has a
    file a bucket without a shuffle of the table."""
    base, batch = upsert_inputs(spark, d)
    first, second, buckets = scratch_path(spark, "buckets"), scratch_path(spark, "buckets"), 8
    create(base, first, buckets)
    merge_buckets(spark, first, second, buckets, batch)
    return read_buckets(spark, second, buckets).select(
        "ads_id", "monthly_rent", "state", "CPI", "scrape_date", ymd("first_seen").alias("first_seen"),
        ymd("last_checked_at").alias("last_checked_at"), "availability_status", ymd("gone_at").alias("gone_at"))


# --------------------------------------------------------------------------- streamed loads
_SLICES = [("CAST(ads_id AS BIGINT) % 3 <> 2", "2026-05-01"), ("CAST(ads_id AS BIGINT) % 3 = 2 OR CAST(ads_id AS BIGINT) % 5 = 0", "2026-05-08")]
_CLEAN_SQL = f"""l AS ({B.order_load_listings_sql()}),
c AS (SELECT l.ads_id, {Q.clean_rent('l.monthly_rent')} AS monthly_rent, l.state, {Q.clean_rooms('l.rooms')} AS rooms, l.property_type,
        {Q.publish_date('l.publishedDatetime')} AS publishedDatetime, {Q.strip_category('l.category_id')} IN ({EXCLUDED_SQL}) AS excluded FROM l)"""


@register("stream_load_archive", _loads_sql(
    _CLEAN_SQL, [f"SELECT * EXCLUDE excluded, '{day}' AS scrape_date FROM c WHERE NOT excluded AND ({rows})" for rows, day in _SLICES],
    ", ".join([f"(SELECT count(*) FROM c WHERE {_SLICES[0][0]}) + (SELECT count(*) FROM c WHERE {_SLICES[1][0]}) AS pulled",
               f"(SELECT count(*) FROM c WHERE NOT excluded AND ({_SLICES[0][0]})) + (SELECT count(*) FROM c WHERE NOT excluded AND ({_SLICES[1][0]})) AS kept",
               "CAST(0 AS BIGINT) AS not_accounted_for, CAST(0 AS BIGINT) AS first_files_left"])))
def stream_load_archive(spark: SparkSession, d: str) -> DataFrame:
    """ST1 + ST2 + S12 + A10: slices land and are streamed into the table by state, then later slices; loaded files move
    to the archive, the counters of all micro-batches add up, and the table equals the full rule after each load."""
    raw, archive, root, ck = (scratch_path(spark, n) for n in ("raw", "archive", "by-state", "ckpt"))
    listings = B.order_load_listings(spark, d)
    for rows, day in _SLICES:
        write_raw(listings.where(rows).withColumn("scrape_date", F.lit(day)), f"{raw}/{day}")
        load_stream(spark, raw, root, ck, mapping_dimension(spark), archive_dir=archive)
    c = read_counters(spark, root).agg(*[F.sum(x).alias(x) for x in ("pulled", "corrupt", "excluded", "blank_key", "kept")]).first()
    left = list_csv(spark, f"{raw}/{_SLICES[0][1]}").count()
    return read_states(spark, root).select(
        "ads_id", "monthly_rent", "state", "rooms", "scrape_date", ymd("first_seen").alias("first_seen"),
        ymd("last_checked_at").alias("last_checked_at"), "availability_status", F.lit(c["pulled"]).alias("pulled"), F.lit(c["kept"]).alias("kept"),
        F.lit(c["pulled"] - c["corrupt"] - c["excluded"] - c["blank_key"] - c["kept"]).alias("not_accounted_for"),
        F.lit(left).cast("bigint").alias("first_files_left"))


_PROBES_SQL = """SELECT count(*) + count(CASE WHEN o_orderkey % 50 <> 0 AND n_lines > 0 THEN 1 END) AS n_alive,
  count(CASE WHEN o_orderkey % 50 <> 0 AND n_lines = 0 THEN 1 END) AS n_gone, count(CASE WHEN o_orderkey % 50 = 0 THEN 1 END) AS n_failed"""


@register("stream_recheck_by_state", f"SELECT t.*, c.* FROM ({_TWO_DAYS_SQL}) t, ({_PROBES_SQL} FROM ({B.order_table_sql()})) c")
def stream_recheck_by_state(spark: SparkSession, d: str) -> DataFrame:
    """ST4 + S7 + A10: the probe log arrives day by day and re-checks the table by state; the counters of all
    micro-batches add up beside the listings."""
    root, src, ck = (scratch_path(spark, n) for n in ("by-state", "probes", "ckpt"))
    table = B.order_table(spark, d)
    fields = [(F.col(f.name) if f.name in table.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.TABLE_SCHEMA.fields]
    overwrite_parts(to_stored(table.select(*fields)), root)
    log = B.order_probe_log(spark, d)
    for day in _AT:
        log.where(F.to_date("checked_at") == day).repartition(1).write.mode("append").parquet(src)
    recheck_states_stream(spark.readStream.schema(S.PROBE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), root, ck)
    c = read_counters(spark, root, RECHECKS).agg(*[F.sum(x).alias(x) for x in ("alive", "gone", "failed")]).first()
    return read_states(spark, root).select(
        "ads_id", "state", "availability_status", ymd("last_checked_at").alias("last_checked_at"), ymd("gone_at").alias("gone_at"),
        *[F.lit(c[x]).alias(f"n_{x}") for x in ("alive", "gone", "failed")])


# --------------------------------------------------------------------------- timers
_EXPIRY = "try_strptime(ad_expiry, '%Y-%m-%d %H:%M:%S')"
_AT = {"2001-07-14": "2001-07-14 09:00:00", "2001-07-15": "2001-07-15 09:00:00"}


def _expire_sql(source: str, day: str) -> str:
    """Listings whose expiry has passed by the probes of a day are expired on the day of their expiry."""
    past = f"({_EXPIRY} <= TIMESTAMP '{_AT[day]}' AND availability_status NOT IN ('rented', 'expired'))"
    return f"""SELECT * REPLACE (CASE WHEN {past} THEN CAST({_EXPIRY} AS DATE) ELSE gone_at END AS gone_at,
  CASE WHEN {past} THEN 'expired' ELSE availability_status END AS availability_status) FROM ({source})"""


def _timer_sql() -> str:
    unasked = "CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE {} END"
    one = _day_step_sql(_expire_sql(B.order_table_sql(), "2001-07-14"), "2001-07-14", f"({unasked.format(repr('alive'))})")
    return _day_step_sql(_expire_sql(one, "2001-07-15"), "2001-07-15", f"({unasked.format(_SECOND_PROBE)})")


@register("stream_timers", f"""SELECT ads_id, state, availability_status, strftime(last_checked_at, '%Y-%m-%d') AS last_checked_at,
  strftime(gone_at, '%Y-%m-%d') AS gone_at FROM ({_timer_sql()})""")
def stream_timers(spark: SparkSession, d: str) -> DataFrame:
    """ST4: two days of probes through the stateful stream, a file a micro-batch; listings expire at their expiry, those
    among them that nobody probes."""
    table_dir, src, sink, ck = (scratch_path(spark, n) for n in ("table", "probes", "changes", "ckpt"))
    B.order_table(spark, d).select("ads_id", "state", "first_seen", "last_checked_at", "availability_status", "gone_at", "ad_expiry") \
        .write.parquet(table_dir)
    table = spark.read.parquet(table_dir)
    log = B.order_probe_log(spark, d).where(F.col("ads_id").cast("bigint") % 9 != 0).withColumn("day", F.to_date("checked_at"))
    for day in _AT:
        log.where(F.col("day") == day).drop("day").repartition(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(S.PROBE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    track_availability(spark, stream, table, sink, ck)
    return apply_changes(table, spark.read.parquet(sink)).select(
        "ads_id", "state", "availability_status", ymd("last_checked_at").alias("last_checked_at"), ymd("gone_at").alias("gone_at"))


# --------------------------------------------------------------------------- lookups that can fail
@register("geo_lookups", """WITH p AS (SELECT p_partkey, p_brand || ', ' || p_type AS query FROM part),
q AS (SELECT query, CASE WHEN bool_or(p_partkey % 2 = 0) THEN 1 ELSE 2 END AS first FROM p GROUP BY query),
s AS (SELECT query, first, (length(query) + first) % 3 AS h FROM q),
f AS (SELECT query, CASE WHEN h = 1 THEN 'miss' ELSE 'hit' END AS lookup_status, CASE WHEN h = 2 THEN 2 ELSE 1 END AS n_lookups,
        CASE h WHEN 0 THEN 100 + first WHEN 2 THEN 101 + first END AS lon FROM s)
SELECT p_partkey, lookup_status, CASE WHEN lookup_status = 'hit' THEN CAST(length(query) AS DOUBLE) END AS latitude, CAST(lon AS DOUBLE) AS longitude,
  CAST(n_lookups AS BIGINT) AS n_lookups FROM p JOIN f USING (query)""")
def geo_lookups(spark: SparkSession, d: str) -> DataFrame:
    """S6 + J3 + T15: three rounds of lookups of places, a third of which fail each time. An error is asked again in the
    next round, a miss is not; the log is appended to, compacted after the second round, and read by its final state."""
    p = read_table(spark, d, "part").select("p_partkey", F.concat_ws(", ", "p_brand", "p_type").alias("query"))
    log_dir, compact, counts = scratch_path(spark, "lookups"), scratch_path(spark, "lookups"), []
    for no in (1, 2, 3):
        wanted = p.where("p_partkey % 2 = 0") if no == 1 else p
        h = (F.length("query") + no) % 3
        at = F.to_timestamp(F.lit(f"2026-05-0{no} 10:00:00"))
        asked = open_queries(wanted, read_lookups(spark, log_dir)).select(
            "query", F.when(h == 0, F.length("query").cast("double")).alias("lat"), F.when(h == 0, F.lit(100.0 + no)).alias("lon"),
            (h == 2).alias("failed"), at.alias("looked_up_at"))
        path = scratch_path(spark, "asked")
        asked.withColumn("status", outcome(F.col("lat"), F.col("lon"), F.col("failed"))).write.parquet(path)
        counts.append(spark.read.parquet(path).select("query"))
        append_lookups(spark.read.parquet(path), log_dir)
        if no == 2:
            compact_lookups(spark, log_dir, compact)
            log_dir = compact
    n = counts[0].unionByName(counts[1]).unionByName(counts[2]).groupBy(F.col("query").alias("asked")).agg(F.count(F.lit(1)).alias("n_lookups"))
    found = with_coordinates(p, "query", read_lookups(spark, log_dir))
    return found.join(n, F.col("query") == F.col("asked")).select("p_partkey", "lookup_status", "latitude", "longitude", "n_lookups")
