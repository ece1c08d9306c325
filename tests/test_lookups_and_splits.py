"""Lookups with outcomes (S6, T15) and CSV files that are split where their content allows it."""

import pytest
from pyspark.sql import functions as F

from letwise.sources.files import CORRUPT, csv_layouts, list_csv, read_raw_csv
from letwise.sources.lookups import append_lookups, compact_lookups, current_lookups, open_queries, outcome, read_lookups, with_coordinates


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("4k", "1")):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def land(path, text):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def layouts(spark, folder):
    found = csv_layouts(spark, [r["file"] for r in list_csv(spark, str(folder)).collect()])
    return {p.split("/")[-1]: (h, by_line) for (h, by_line), paths in found.items() for p in paths}


def test_layout_is_chosen_by_content(spark, tmp_path, small_splits):
    rows = "".join(f'{i},"Room, ""big"" {i}",Johor\n' for i in range(600))
    land(tmp_path / "r" / "plain.csv", "ads_id,category_id,state\n" + rows)
    land(tmp_path / "r" / "crlf.csv", ("ads_id,category_id,state\n" + rows).replace("\n", "\r\n"))
    land(tmp_path / "r" / "late.csv", "ads_id,category_id,state\n" + rows + '9999,"Room,\nFlat",Johor\n')
    land(tmp_path / "r" / "cr.csv", "ads_id,category_id,state\n" + rows + "9998,a\rb,Johor\n")
    land(tmp_path / "r" / "empty.csv", "")
    head = "ads_id,category_id,state"
    assert layouts(spark, tmp_path / "r") == {"plain.csv": (head, True), "crlf.csv": (head, True), "late.csv": (head, False), "cr.csv": (head, False)}


def test_a_file_without_line_breaks_in_fields_is_many_tasks(spark, tmp_path, small_splits):
    text = "ads_id,category_id,state\n" + "".join(f'{i:04d},"Room, ""big"" {i}",Johor\n' for i in range(1500)) + "short\n"
    one = land(tmp_path / "a" / "x.csv", text)
    other = land(tmp_path / "b" / "x.csv", text + 'z,"two\nlines",Johor\n')     # the same rows as one task, and one more
    split, whole = read_raw_csv(spark, [one]), read_raw_csv(spark, [other])
    pieces = lambda df: df.select(F.spark_partition_id()).distinct().count()
    assert pieces(split) > 3 and pieces(whole) == 1
    rows = lambda df: sorted(map(tuple, df.drop("load_key", "source_file").collect()), key=str)
    assert [r for r in rows(whole) if r[0] != "z"] == rows(split) and len(rows(split)) == 1501
    assert [r[CORRUPT] for r in split.where(F.col(CORRUPT).isNotNull()).collect()] == ["short"]
    placed = [r.ads_id for r in split.where(F.col(CORRUPT).isNull()).orderBy("load_key").collect()]
    assert placed == sorted(placed) and len(placed) == 1500                        # load_key follows the place in the file


LOG = "query string, lat double, lon double, failed boolean, at string"


def lookups(spark, rows):
    f = spark.createDataFrame(rows, LOG)
    return f.select("query", outcome(F.col("lat"), F.col("lon"), F.col("failed")).alias("status"), "lat", "lon", F.to_timestamp("at").alias("looked_up_at"))


def test_errors_are_asked_again_and_misses_are_not(spark, tmp_path):
    path = str(tmp_path / "log")
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("",), ("  ",), (None,), ("d",)], "query string")
    assert sorted(r.query for r in open_queries(wanted, read_lookups(spark, path)).collect()) == ["a", "b", "c", "d"]
    append_lookups(lookups(spark, [("a", 1.0, 2.0, False, "2026-05-01 10:00:00"), ("b", None, None, False, "2026-05-01 10:00:00"),
                                   ("c", 9.0, 9.0, True, "2026-05-01 10:00:00"), (None, 1.0, 1.0, False, "2026-05-01 10:00:00"),
                                   ("half", 1.0, None, None, "2026-05-01 10:00:00")]), path)
    assert sorted(r.query for r in open_queries(wanted, read_lookups(spark, path)).collect()) == ["c", "d"]
    append_lookups(lookups(spark, [("c", 3.0, 4.0, False, "2026-05-02 10:00:00"), ("a", None, None, True, "2026-05-02 10:00:00"),
                                   ("d", None, None, True, "2026-05-02 10:00:00")]), path)
    now = {r.query: (r.status, r.lat, r.lon) for r in current_lookups(read_lookups(spark, path)).collect()}
    assert now == {"a": ("hit", 1.0, 2.0), "b": ("miss", None, None), "c": ("hit", 3.0, 4.0), "d": ("error", None, None), "half": ("miss", None, None)}
    assert [r.query for r in open_queries(wanted, read_lookups(spark, path)).collect()] == ["d"]
    rows = wanted.withColumn("latitude", F.lit(7.0))
    assert sorted((r.query, r.latitude, r.lookup_status) for r in with_coordinates(rows, "query", read_lookups(spark, path)).where("trim(query) <> ''").collect()) == [
        ("a", 1.0, "hit"), ("a", 1.0, "hit"), ("b", None, "miss"), ("c", 3.0, "hit"), ("d", None, "error")]
    assert with_coordinates(rows, "query", read_lookups(spark, path)).count() == rows.count()


def test_newest_final_lookup_wins_and_survives_compaction_and_replay(spark, tmp_path):
    path = str(tmp_path / "log")
    later = lookups(spark, [("a", None, None, False, "2026-05-03 10:00:00"), ("b", 5.0, 5.0, False, "2026-05-01 10:00:00")])
    append_lookups(lookups(spark, [("a", 1.0, 2.0, False, "2026-05-01 10:00:00"), ("b", 4.0, 4.0, False, "2026-05-01 10:00:00")]), path)
    append_lookups(later, path)
    append_lookups(later, path)
    state = sorted(map(tuple, current_lookups(read_lookups(spark, path)).drop("looked_up_at").collect()))
    assert state == [("a", "miss", None, None), ("b", "hit", 5.0, 5.0)]
    assert sorted(map(tuple, compact_lookups(spark, path, str(tmp_path / "next")).drop("looked_up_at").collect())) == state
