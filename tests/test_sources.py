"""Landed pages (FIXTURES 5), raw CSV reader, coordinate import and versioned snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from letwise import schemas as S
from letwise.operators.flatten import item_to_row
from letwise.sources.files import (
    bad_pages,
    geo_from_json_object,
    read_page_log,
    read_pages,
    read_raw_csv,
    split_corrupt,
    write_raw,
)
from letwise.sources.snapshot import commit_state, current_version, read_snapshot, write_snapshot

FULL_ITEM = {"id": 1, "attributes": {
    "list_id": 70010, "price_label": "RM 3,450", "property_type_name": "Duplex",
    "category_name": "House", "region_name": "Eastland", "subarea_name": "Northfield",
    "building_name": "Quarry Court", "rooms_name": "4", "bathroom_name": "3", "size": "1480",
    "size_suffix": "sq.ft.", "published_date": "2026-03-17 08:05:00", "property_type_id": 9,
    "store_verified": ["a", "b"]}}
SPARSE_ITEM = {"id": 2, "attributes": {"list_id": 31, "region_name": "Eastland"}}


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_page_scan_and_flatten(spark, tmp_path):
    page = {"data": [FULL_ITEM, SPARSE_ITEM], "meta": {"total-results": 2, "total-showing": 2}}
    write_lines(tmp_path / "p1.json", [json.dumps(page), "{not json"])
    rows = {r.ads_id: r for r in item_to_row(read_pages(spark, str(tmp_path))).collect()}
    full = rows["70010"]
    assert full.monthly_rent == "RM 3,450 per month"
    assert full.category_id == "House, For rent"
    assert full.size == "1480 sq.ft."
    assert full.address == "Quarry Court, Northfield, Eastland"
    assert full.publishedDatetime == "2026-03-17 08:05:00"
    assert full.property_type_id == "9" and full.store_verified == "a, b"
    assert full.geo_query == "Quarry Court, Northfield, Eastland, Malaysia"
    sparse = rows["31"]
    assert sparse.address == "Eastland" and sparse.monthly_rent == "" and sparse.category_id == ""
    assert sparse.geo_query == "Eastland, Malaysia"
    log = read_page_log(spark, str(tmp_path))
    assert [r["_corrupt_record"] for r in bad_pages(log).collect()] == ["{not json"]


def test_page_boundary(spark, tmp_path):
    items = [{"id": i, "attributes": {"list_id": i}} for i in range(206)]
    write_lines(tmp_path / "a.json", [json.dumps({"data": items[:200], "meta": {"total-results": 206}}),
                                      json.dumps({"data": items[200:], "meta": {"total-results": 206}})])
    out = read_pages(spark, str(tmp_path))
    assert out.count() == 206
    assert out.select(F.countDistinct("item.attributes.list_id")).first()[0] == 206


def test_raw_csv_roundtrip_all_text(spark, tmp_path):
    df = spark.createDataFrame([("1", "RM 1,200 per month", "3", "s1", "2"), ("2", None, "None", "s1", "2"),
                                ("3", "RM 900 per month", None, "s2", "4")],
                               "ads_id string, monthly_rent string, rooms string, state string, property_type_id string")
    write_raw(df, str(tmp_path / "raw"))
    # a combined snapshot in the same tree must be skipped
    (tmp_path / "raw" / "s1_ALL_20260101.csv").write_text(",".join(S.RAW_COLUMNS) + "\n" + "9" + "," * (len(S.RAW_COLUMNS) - 1) + "\n")
    got, bad = split_corrupt(read_raw_csv(spark, str(tmp_path / "raw")))
    rows = {r.ads_id: r for r in got.collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"].rooms == "3" and rows["1"].monthly_rent == "RM 1,200 per month"   # T4: text stays text
    assert rows["2"].rooms is None and rows["2"].monthly_rent is None                  # T3: NA tokens
    assert dict(zip(got.columns, [f.dataType.simpleString() for f in got.schema.fields]))["rooms"] == "string"


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('state,extra,ads_id,monthly_rent\ns1,x,1,RM 1\n"s,2",y,2,\nshort\n')
    (tmp_path / "c.csv").write_text("\ufeffads_id,CPI\r\n3,Duplex\r\n,\r\n4,a,b\r\n")
    (tmp_path / "nokey.csv").write_text("state,rooms\ns9,3\n")
    (tmp_path / "empty.csv").write_text("")
    df = read_raw_csv(spark, str(tmp_path))
    good, bad = split_corrupt(df)
    got = {r.ads_id: (r.state, r.monthly_rent, r.CPI, r.source_file) for r in good.collect()}
    assert got == {"1": ("s1", "RM 1", None, "a%20b.csv"), "2": ("s,2", None, None, "a%20b.csv"), "3": (None, None, "Duplex", "c.csv")}
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["4,a,b", "s9,3", "short"]
    assert read_raw_csv(spark, []).count() == 0


def test_geo_import(spark):
    text = json.dumps({"Northfield, Eastland, Malaysia": [3.07, 101.52], "Ghost, Malaysia": [None, None]})
    df = spark.createDataFrame([(text,)], "value string")
    out = {r.query: (r.lat, r.lon) for r in geo_from_json_object(df).collect()}
    assert out == {"Northfield, Eastland, Malaysia": (3.07, 101.52), "Ghost, Malaysia": (None, None)}


def test_snapshot_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    assert current_version(spark, root) is None and read_snapshot(spark, root) is None
    v1 = write_snapshot(spark.createDataFrame([("1", 1.0)], "ads_id string, x double"), root)
    v2 = write_snapshot(spark.createDataFrame([("1", 2.0), ("2", 3.0)], "ads_id string, x double"), root,
                        writer_id="w", batch_id=7)
    assert (v1, v2) == (1, 2)
    assert read_snapshot(spark, root).count() == 2
    assert read_snapshot(spark, root, 1).first().x == 1.0
    assert commit_state(spark, root, "w", 7) == (2, True)
    assert commit_state(spark, root, "w", 8) == (2, False)


def test_snapshot_ignores_uncommitted_version(spark, tmp_path):
    root = str(tmp_path / "table")
    write_snapshot(spark.createDataFrame([("1",)], "ads_id string"), root)
    # an orphan folder of a failed attempt is invisible and is replaced by the retry
    spark.createDataFrame([("x",), ("y",)], "ads_id string").write.parquet(f"{root}/v=00000002")
    assert current_version(spark, root) == 1 and read_snapshot(spark, root).count() == 1
    assert write_snapshot(spark.createDataFrame([("1",), ("2",)], "ads_id string"), root) == 2
    assert sorted(r[0] for r in read_snapshot(spark, root).collect()) == ["1", "2"]


def test_corrupt_commit_log_fails_loudly(spark, tmp_path):
    root = tmp_path / "table"
    (root / "_commits" / "version=1").mkdir(parents=True)
    (root / "_commits" / "version=1" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        current_version(spark, str(root))
