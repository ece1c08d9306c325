"""Streaming jobs: exactly-once ingest, idempotent upsert sink, watermark dedup, re-check."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from letwise.operators.clean import mapping_dimension
from letwise.session import scratch_path
from letwise.sources.files import write_raw
from letwise.sources.snapshot import current_version, read_snapshot, write_snapshot
from letwise.streaming.jobs import dedup_sightings, ingest_raw, recheck_stream, upsert_stream
from letwise.operators.upsert import upsert


def test_ingest_exactly_once(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("raw", "sink", "ck"))
    df = spark.createDataFrame([("1", "RM 1,000 per month", "Room, For rent", "s1", "2", "Studio"),
                                ("2", "RM 2,000 per month", "Land, For rent", "s1", "2", "Flat")],
                               "ads_id string, monthly_rent string, category_id string, state string, "
                               "property_type_id string, property_type string")
    write_raw(df, src)
    ingest_raw(spark, src, sink, ck, mapping_dimension(spark))
    ingest_raw(spark, src, sink, ck, mapping_dimension(spark))      # nothing new
    out = spark.read.parquet(sink).collect()
    assert [(r.ads_id, r.monthly_rent, r.CPI) for r in out] == [("1", 1000.0, "Apartment")]
    write_raw(df.withColumn("ads_id", F.lit("3")).limit(1), src)   # a new file arrives
    ingest_raw(spark, src, sink, ck, mapping_dimension(spark))
    assert sorted(r.ads_id for r in spark.read.parquet(sink).collect()) == ["1", "3"]


def test_upsert_stream_matches_batch_and_skips_replay(spark):
    src, root, ck = (scratch_path(spark, n) for n in ("days", "table", "ck"))
    rows = spark.createDataFrame([("a", 1.0, "2026-05-01"), ("a", 2.0, "2026-05-03"), ("b", 5.0, "2026-05-02"),
                                  ("a", 9.0, "2026-05-02"), (None, 1.0, "2026-05-01")],
                                 "ads_id string, monthly_rent double, scrape_date string")
    rows.withColumn("day", F.col("scrape_date")).repartition("day").write.partitionBy("day").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    upsert_stream(stream, root, ck, writer_id="w", quarantine_dir=scratch_path(spark, "q"))
    v = current_version(spark, root)
    got = {r.ads_id: r.monthly_rent for r in read_snapshot(spark, root).collect()}
    assert got == {"a": 2.0, "b": 5.0}
    # batch answer is the same
    batch = {r.ads_id: r.monthly_rent for r in upsert(None, rows.where("ads_id IS NOT NULL")).collect()}
    assert got == batch
    # one file a batch in the other order gives the same table
    other = scratch_path(spark, "table")
    for day in ("2026-05-03", "2026-05-02", "2026-05-01"):
        upsert_stream(spark.readStream.schema(rows.schema).parquet(f"{src}/day={day}"), other, scratch_path(spark, "ck"), writer_id="w")
    assert {r.ads_id: r.monthly_rent for r in read_snapshot(spark, other).collect()} == got   # three checkpoints, none skipped
    assert spark.read.parquet(f"{other}/_quarantine").count() == 1
    # a rerun from the same checkpoint changes nothing
    upsert_stream(spark.readStream.schema(rows.schema).parquet(src), root, ck, writer_id="w")
    assert current_version(spark, root) == v


def test_new_checkpoint_never_overwrites(spark):
    sink = scratch_path(spark, "sink")
    for name in ("1", "2"):
        src = scratch_path(spark, "raw")
        write_raw(spark.createDataFrame([(name, "s1", "2")], "ads_id string, state string, property_type_id string"), src)
        ingest_raw(spark, src, sink, scratch_path(spark, "ck"))
    assert sorted(r.ads_id for r in spark.read.parquet(sink).collect()) == ["1", "2"]


def test_probes_wait_for_the_table(spark):
    root, src, ck = (scratch_path(spark, n) for n in ("table", "probes", "ck"))
    schema = "ads_id string, checked_at timestamp, http_ok boolean, n_items long"
    spark.createDataFrame([("a", dt.datetime(2026, 6, 1, 9), True, 0)], schema).write.parquet(src)
    with pytest.raises(Exception, match="no table"):
        recheck_stream(spark.readStream.schema(schema).parquet(src), root, ck, writer_id="p")
    write_snapshot(upsert(None, spark.createDataFrame([("a", "2026-05-01")], "ads_id string, scrape_date string")), root)
    recheck_stream(spark.readStream.schema(schema).parquet(src), root, ck, writer_id="p")
    assert read_snapshot(spark, root).first().availability_status == "expired"


def test_dedup_sightings(spark):
    src = scratch_path(spark, "sightings")
    spark.createDataFrame([("a", dt.datetime(2026, 5, 1, 10)), ("a", dt.datetime(2026, 5, 1, 11)),
                           ("b", dt.datetime(2026, 5, 1, 12))], "ads_id string, seen_at timestamp").write.parquet(src)
    s = spark.readStream.schema("ads_id string, seen_at timestamp").parquet(src)
    q = dedup_sightings(s).writeStream.format("memory").queryName("sightings").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.ads_id for r in spark.sql("SELECT * FROM sightings").collect()) == ["a", "b"]


def test_recheck_stream(spark):
    root, src, ck = (scratch_path(spark, n) for n in ("table", "probes", "ck"))
    t = upsert(None, spark.createDataFrame([("a", "2026-05-01", "2099-01-01 00:00:00"), ("b", "2026-05-01", "2099-01-01 00:00:00")],
                                           "ads_id string, scrape_date string, ad_expiry string"))
    write_snapshot(t, root)
    spark.createDataFrame([("a", dt.datetime(2026, 6, 1, 9), True, 0), ("b", dt.datetime(2026, 6, 1, 9), True, 1)],
                          "ads_id string, checked_at timestamp, http_ok boolean, n_items long").write.parquet(src)
    probes = spark.readStream.schema("ads_id string, checked_at timestamp, http_ok boolean, n_items long").parquet(src)
    recheck_stream(probes, root, ck, writer_id="probes")
    out = {r.ads_id: (r.availability_status, r.last_checked_at) for r in read_snapshot(spark, root).collect()}
    assert out == {"a": ("rented", dt.date(2026, 6, 1)), "b": ("active", dt.date(2026, 6, 1))}
