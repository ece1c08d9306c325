"""Streams into the kept tables: records without a fixed header (ST1), archive (S12), counters (A10), timers (ST4)."""

import glob

import pytest
from pyspark.sql import functions as F

from letwise import schemas as S
from letwise.operators.availability import recheck_by_day
from letwise.operators.clean import mapping_dimension
from letwise.sources.files import CORRUPT, read_raw_csv
from letwise.sources.records import WIDTH, named_rows, record_stream, staged_records
from letwise.sources.states import read_states
from letwise.streaming.expiry import apply_changes, is_due, track_availability
from letwise.streaming.jobs import ingest_raw, load_stream, read_counters


def land(folder, name, text, newline="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.replace("\n", newline).encode())


def streamed(spark, folder, ck):
    """The rows of a folder as the stream names them."""
    out = []

    def take(batch, _):
        out.extend(named_rows(staged_records(batch)).drop("load_key").collect())

    record_stream(spark, str(folder)).writeStream.foreachBatch(take).option("checkpointLocation", str(ck)).trigger(availableNow=True).start().awaitTermination()
    return sorted(map(tuple, out), key=str)


def test_records_equal_the_batch_reader(spark, tmp_path):
    src = tmp_path / "raw"
    land(src, "a.csv", 'ads_id,monthly_rent,category_id,state\n1,RM 5 per month,"Room, For rent",Johor\n2,,"two\nlines, and ""quotes""",\n3,RM 1\n4,a,b,c,d\n')
    land(src, "b.csv", "﻿state,extra, ads_id \nKedah,x,5\nNA,NULL,\n\nJohor,,6\n", "\r\n")
    land(src, "c.csv", "state,monthly_rent\nJohor,1\n")                     # no key column
    land(src, "d.csv", "ads_id,state\n")                                      # a header only
    land(src, "x_ALL_2026.csv", "ads_id,state\n9,Perak\n")                    # a combined snapshot
    land(src, "e.txt", "ads_id\n8\n")
    batch = sorted(map(tuple, read_raw_csv(spark, str(src)).drop("load_key").collect()), key=str)
    stream = streamed(spark, src, tmp_path / "ck")
    at = len(S.RAW_COLUMNS) + 1                                               # where the corrupt record stands
    good = lambda rows: [r for r in rows if r[at] is None]
    assert good(stream) == good(batch) and {r[0] for r in good(stream)} == {"1", "2", "5", "6"}
    assert sorted(r[at].strip() for r in stream if r[at]) == sorted(r[at].strip() for r in batch if r[at]) == ["3,RM 1", "4,a,b,c,d", "Johor,1"]


def test_wide_records_are_kept_apart(spark, tmp_path):
    src = tmp_path / "raw"
    wide = ["ads_id", *[f"x{i}" for i in range(WIDTH)]]
    land(src, "wide.csv", ",".join(wide) + "\n" + ",".join(["1"] * len(wide)) + "\n")
    land(src, "full.csv", ",".join(wide[:WIDTH]) + "\n" + ",".join(["2"] * WIDTH) + "\n" + ",".join(["3"] * 2) + "\n")
    rows = streamed(spark, src, tmp_path / "ck")
    at = len(S.RAW_COLUMNS) + 1
    assert [r[0] for r in rows if r[at] is None] == ["2"] and sum(r[at] is not None for r in rows) == 2


def test_a_landed_file_is_many_tasks_in_the_stream(spark, tmp_path):
    src, tasks, rows = tmp_path / "raw", [], []
    land(src, "plain.csv", "ads_id,state,address\n" + "".join(f'{i:04d},"Johor, ""J""",\n' for i in range(800)))
    land(src, "broken[1].csv", "ads_id,state,address\n" + "".join(f'9{i:03d},Kedah,"a\nb"\n' for i in range(300)))

    def take(batch, _):
        tasks.append(batch.rdd.getNumPartitions())
        rows.extend(named_rows(staged_records(batch)).orderBy("load_key").collect())

    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        record_stream(spark, str(src)).writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "ck")) \
            .trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks[0] > 5                                                       # two files, a task each before
    assert all(r[CORRUPT] is None for r in rows)
    good = [(r.ads_id, r.state, r.address) for r in rows]
    assert [x for x in good if x[1] != "Kedah"] == [(f"{i:04d}", 'Johor, "J"', None) for i in range(800)]   # load_key follows the place
    assert [x for x in good if x[1] == "Kedah"] == [(f"9{i:03d}", "Kedah", "a\nb") for i in range(300)]


def test_a_line_that_may_not_be_a_record_is_left_to_the_csv_reader(spark, tmp_path):
    src = tmp_path / "raw"
    land(src, "a.csv", 'ads_id,state,address\n1,a","b\n2,c"\n3,Perak,x\n')          # quotes are even, yet a field runs on
    land(src, "b.csv", 'ads_id,state\n4,"Johor"\r\n5,Perak\n')                       # line ends of two kinds
    rows = streamed(spark, src, tmp_path / "ck")
    at = len(S.RAW_COLUMNS) + 1
    assert sorted(r[0] for r in rows if r[at] is None) == ["1", "3", "4", "5"]


LISTING = "ads_id,monthly_rent,state,scrape_date\n"


def test_loaded_files_move_and_counters_add_up(spark, tmp_path):
    src, archive, root, ck = tmp_path / "raw", tmp_path / "archive", str(tmp_path / "table"), str(tmp_path / "ck")
    land(src, "1.csv", LISTING + "1,RM 10 per month,Johor,2026-05-01\n2,RM 20 per month,Kedah,2026-05-01\n3,short\n ,RM 1 per month,Johor,2026-05-01\n")
    load_stream(spark, str(src), root, ck, mapping_dimension(spark), archive_dir=str(archive))
    land(src, "2.csv", LISTING + "2,RM 25 per month,Perak,2026-05-02\n")
    load_stream(spark, str(src), root, ck, mapping_dimension(spark), archive_dir=str(archive))
    assert {r.ads_id: (r.state, r.monthly_rent) for r in read_states(spark, root).collect()} == {"1": ("Johor", 10.0), "2": ("Perak", 25.0)}
    assert glob.glob(f"{archive}/**/1.csv", recursive=True) and not (src / "1.csv").exists()
    c = {r.batch_id: r for r in read_counters(spark, root).collect()}
    assert [(c[i].pulled, c[i].corrupt, c[i].blank_key, c[i].excluded, c[i].kept) for i in (0, 1)] == [(4, 1, 1, 0, 2), (1, 0, 0, 0, 1)]
    assert all(r.records == r.pulled + 1 for r in c.values())                 # and a header
    load_stream(spark, str(src), root, ck, mapping_dimension(spark), archive_dir=str(archive))   # nothing new
    assert read_counters(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/_quarantine/kind=corrupt").where(F.col(CORRUPT).isNotNull()).count() == 1


def test_files_of_a_failed_batch_stay(spark, tmp_path, monkeypatch):
    from letwise.streaming import jobs
    src, archive, root, ck = tmp_path / "raw", tmp_path / "archive", str(tmp_path / "table"), str(tmp_path / "ck")
    land(src, "1.csv", LISTING + "1,RM 10 per month,Johor,2026-05-01\n")
    def broken(*_):
        raise ValueError("no table today")

    whole = jobs.merge_states
    monkeypatch.setattr(jobs, "merge_states", broken)
    with pytest.raises(Exception, match="no table today"):
        load_stream(spark, str(src), root, ck, mapping_dimension(spark), archive_dir=str(archive))
    assert (src / "1.csv").exists() and not glob.glob(f"{archive}/**/*.csv", recursive=True)
    monkeypatch.setattr(jobs, "merge_states", whole)
    load_stream(spark, str(src), root, ck, mapping_dimension(spark), archive_dir=str(archive))
    assert [r.ads_id for r in read_states(spark, root).collect()] == ["1"]


def test_ingest_counters_and_archive(spark, tmp_path):
    src, archive, sink = tmp_path / "raw", tmp_path / "archive", str(tmp_path / "sink")
    land(src, "1.csv", LISTING + "1,RM 10 per month,Johor,2026-05-01\n2,x\n")
    for _ in range(2):
        ingest_raw(spark, str(src), sink, str(tmp_path / "ck"), mapping_dimension(spark), archive_dir=str(archive))
        land(src, "2.csv", LISTING + "3,RM 10 per month,Johor,2026-05-01\n")
    total = read_counters(spark, sink).agg(F.sum("pulled"), F.sum("corrupt"), F.sum("kept"), F.sum("excluded")).first()
    assert tuple(total) == (3, 1, 2, 0) and spark.read.parquet(sink).count() == 2


# --------------------------------------------------------------------------- timers
PROBES = "ads_id string, checked_at timestamp, http_ok boolean, n_items long"
TABLE = "ads_id string, first_seen date, last_checked_at date, availability_status string, gone_at date, ad_expiry string"


def probe_stream(spark, folder, days, per_trigger=1):
    for i, rows in enumerate(days):
        frame = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in rows], "ads_id string, at string, http_ok boolean, n_items long")
        frame.select("ads_id", F.to_timestamp("at").alias("checked_at"), "http_ok", "n_items").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(PROBES).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def listings(spark):
    rows = [("a", "2026-05-01", None, "active", None, "2026-06-10 12:00:00"),     # expires between the probes
            ("b", "2026-05-01", "2026-05-30", "active", None, "2026-12-01 00:00:00"),
            ("c", "2026-05-01", None, "active", None, "2026-06-05 00:00:00"),     # never probed
            ("d", "2026-05-01", None, "rented", "2026-05-20", "2026-06-05 00:00:00"),
            ("e", "2026-05-01", None, None, None, "no date"), ("f", None, None, "active", None, None)]
    day = lambda c: F.to_date(c).alias(c)
    return spark.createDataFrame(rows, "ads_id string, first_seen string, last_checked_at string, availability_status string, gone_at string, ad_expiry string") \
        .select("ads_id", day("first_seen"), day("last_checked_at"), "availability_status", day("gone_at"), "ad_expiry")


DAYS = [[("a", "2026-06-01 09:00:00", True, 1), ("b", "2026-06-01 09:00:00", True, 1), ("e", "2026-06-01 09:00:00", True, 0)],
        [("a", "2026-06-12 09:00:00", True, 1), ("b", "2026-06-12 09:00:00", True, 0), ("d", "2026-06-12 09:00:00", True, 1),
         ("f", "2026-06-12 09:00:00", False, 0), ("zz", "2026-06-12 10:00:00", True, 1), (None, "2026-06-12 10:00:00", True, 1)]]


def status(df):
    return {r.ads_id: (r.availability_status, str(r.last_checked_at), str(r.gone_at)) for r in df.collect()}


@pytest.mark.parametrize("per_trigger", [1, 5])
def test_without_timers_the_stream_equals_the_batch_recheck(spark, tmp_path, per_trigger):
    table = listings(spark)
    stream = probe_stream(spark, str(tmp_path / "p"), DAYS, per_trigger)
    track_availability(spark, stream, table, str(tmp_path / "s"), str(tmp_path / "ck"), expire=False)
    log = spark.read.schema(PROBES).parquet(str(tmp_path / "p"))
    assert status(apply_changes(table, spark.read.parquet(str(tmp_path / "s")))) == status(recheck_by_day(table, log))


@pytest.mark.parametrize("per_trigger", [1, 5])
def test_expiry_fires_without_a_probe(spark, tmp_path, per_trigger):
    table = listings(spark)
    stream = probe_stream(spark, str(tmp_path / "p"), DAYS, per_trigger)
    track_availability(spark, stream, table, str(tmp_path / "s"), str(tmp_path / "ck"))
    changes = spark.read.parquet(str(tmp_path / "s"))
    now = status(apply_changes(table, changes))
    assert now["c"] == ("expired", "None", "2026-06-05")
    assert now["a"] == ("expired", "2026-06-01", "2026-06-10")                 # the later probe came too late
    assert now["b"] == ("rented", "2026-06-12", "2026-06-12")
    assert now["d"] == ("rented", "None", "2026-05-20") and now["e"][0] == "expired" and now["f"] == ("active", "None", "None")
    assert {r.ads_id for r in changes.where("cause = 'expiry'").collect()} == {"a", "c"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_due_rule_of_one_listing_equals_the_column_rule(spark):
    from letwise.operators.availability import with_due_flag
    rows = [(s, f, c) for s in ("active", None, "rented", "expired") for f in (None, "2026-05-30", "2026-05-20", "2026-01-01", "2026-07-01")
            for c in (None, "2026-06-01", "2026-05-31", "2026-05-29", "2026-05-20")]
    frame = spark.createDataFrame(rows, "availability_status string, first_seen string, last_checked_at string")
    for r in with_due_flag(frame, "2026-06-01").collect():
        assert is_due(r.availability_status, r.first_seen, r.last_checked_at, "2026-06-01") == r._due


@pytest.mark.parametrize("buckets", [1, 3])
def test_listings_of_a_bucket_share_a_state_and_its_timer(spark, tmp_path, buckets):
    """a bucket is one key of the state store; each of its listings expires on its own day."""
    table = listings(spark)
    days = [*DAYS, [("zz", "2026-12-02 09:00:00", True, 1)], [("f", "2026-12-03 09:00:00", True, 0)]]
    stream = probe_stream(spark, str(tmp_path / "p"), days)
    q = track_availability(spark, stream, table, str(tmp_path / "s"), str(tmp_path / "ck"), buckets=buckets)
    changes = spark.read.parquet(str(tmp_path / "s"))
    now = status(apply_changes(table, changes))
    assert now["c"] == ("expired", "None", "2026-06-05") and now["a"] == ("expired", "2026-06-01", "2026-06-10")
    assert now["b"] == ("rented", "2026-06-12", "2026-06-12") and now["d"] == ("rented", "None", "2026-05-20")
    assert now["e"][0] == "expired" and now["f"] == ("expired", "2026-12-03", "2026-12-03")
    assert changes.groupBy("ads_id", "change_no").count().where("count > 1").count() == 0
    assert {r.ads_id for r in changes.where("cause = 'expiry'").collect()} == {"a", "c"}
    assert q.exception() is None


def test_rechecks_land_their_log_without_joining_it_in_one_task(spark, tmp_path, monkeypatch):
    """A file a day is one task's rows, but the joins that make them are not that task's work."""
    from letwise.plans import catalog, catalog_tables  # noqa: F401
    d = str(tmp_path)
    spark.sql("select id as o_orderkey, 'F' as o_orderstatus, '2-HIGH' as o_orderpriority, timestamp'2001-06-20 00:00:00' as o_orderdate from range(60)") \
        .write.parquet(f"{d}/orders.parquet")
    spark.sql("select id % 40 as l_orderkey, timestamp'2001-06-25 00:00:00' as l_shipdate from range(80)").write.parquet(f"{d}/lineitem.parquet")

    def narrowed(frame, n):
        raise AssertionError("the stage before coalesce runs in so few tasks")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", narrowed)
    rows = [sorted(map(str, catalog.QUERIES[x](spark, d).select("ads_id", "availability_status", "last_checked_at", "gone_at").collect()))
            for x in ("stream_recheck", "stream_recheck_days", "stream_recheck_by_state")]
    assert len(rows[0]) == 60 and rows[0] == rows[1] == rows[2]
