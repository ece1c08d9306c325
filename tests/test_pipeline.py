"""Batch pipeline runs end to end, and plan properties of every registered query."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from letwise.operators.clean import mapping_dimension
from letwise.plans import catalog
from letwise.plans.pipeline import full_run, load_raw
from letwise.session import scratch_path
from letwise.sources.snapshot import read_snapshot, write_snapshot


def item(i, rent, cat="Apartment / Condominium", ptype="Condominium", building="Block A", sub="Northfield"):
    return {"id": i, "attributes": {"list_id": i, "price_label": rent, "category_name": cat, "property_type_name": ptype,
                                    "region_name": "Eastland", "subarea_name": sub, "building_name": building,
                                    "rooms_name": "3.0", "size": "900", "size_suffix": "sq.ft.",
                                    "published_date": "2026-05-02 20:10:31"}}


def test_full_run_twice(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    items = [item(1, "RM 1,000"), item(2, "RM 2,000", cat="Land"), item(3, "RM 3,000", building=None),
             item(4, "RM 1,000"),   # content duplicate of 1 (same rent, type, place, rooms, size, date)
             {"id": 5, "attributes": {"list_id": None, "price_label": "RM 9"}}]
    (pages / "p.json").write_text(json.dumps({"data": items, "meta": {"total-results": 5}}) + "\n{broken\n")
    geo = spark.createDataFrame([("Block A, Northfield, Eastland, Malaysia", 3.0, 101.0),
                                 ("Northfield, Eastland, Malaysia", 3.1, 101.1)], "query string, lat double, lon double")
    root = scratch_path(spark, "table")
    res = full_run(spark, str(pages), root, geo, mapping_dimension(spark), "2026-05-03",
                   quarantine_dir=scratch_path(spark, "q"))
    t = {r.ads_id: r for r in read_snapshot(spark, root).collect()}
    assert sorted(t) == ["1", "3"]                      # Land excluded, 4 is a content duplicate of 1, blank id quarantined
    assert t["1"].monthly_rent == 1000.0 and t["1"].CPI == "Condominium" and t["1"].rooms == "3"
    assert (t["1"].latitude, t["3"].latitude) == (3.0, 3.1)
    assert t["1"].publishedDatetime == "05/02/2026" and str(t["1"].first_seen) == "2026-05-03"
    assert res.counters["pulled"] == 5 and res.counters["dedup_removed"] == 1
    assert res.counters["bad_pages"] == 1 and res.counters["blank_key"] == 1 and res.counters["excluded"] == 1
    # second run over the same pages: everything known is skipped, table unchanged
    res2 = full_run(spark, str(pages), root, geo, mapping_dimension(spark), "2026-05-04")
    assert res2.version == res.version + 1
    assert res2.counters["skipped_known"] == 2
    assert sorted(r.ads_id for r in read_snapshot(spark, root).collect()) == ["1", "3"]


def test_rerun_keeps_history_and_counts_add_up(spark, tmp_path):
    raw, root = tmp_path / "raw", scratch_path(spark, "table")
    raw.mkdir()
    (raw / "1.csv").write_text("ads_id,monthly_rent,category_id,scrape_date\na,RM 5 per month,Room,2026-05-01\n"
                               " ,RM 6 per month,Room,2026-05-01\nb,RM 7 per month,Land,2026-05-01\nshort row\n")
    res = load_raw(spark, str(raw), root, mapping_dimension(spark))
    c = res.counters
    assert (c["files"], c["pulled"], c["corrupt"], c["blank_key"], c["excluded"], c["kept"]) == (1, 4, 1, 1, 1, 1)
    held = spark.read.option("recursiveFileLookup", True)
    assert held.parquet(f"{root}/_quarantine/kind=corrupt").count() == 1 and held.parquet(f"{root}/_quarantine/kind=blank_key").count() == 1
    t = read_snapshot(spark, root)
    write_snapshot(t.withColumn("availability_status", F.lit("rented")).withColumn("gone_at", F.to_date(F.lit("2026-05-10"))), root)
    before = sorted(map(tuple, read_snapshot(spark, root).collect()))
    again = load_raw(spark, str(raw), root, mapping_dimension(spark))
    assert again.counters["pulled"] == 0 and sorted(map(tuple, read_snapshot(spark, root).collect())) == before
    (raw / "2.csv").write_text("scrape_date,ads_id,monthly_rent\n2026-05-20,a,RM 9 per month\n")
    assert load_raw(spark, str(raw), root, mapping_dimension(spark)).counters["pulled"] == 1
    row = read_snapshot(spark, root).first()
    assert row.availability_status == "active" and row.gone_at is None and row.monthly_rent == 9.0
    assert str(row.first_seen) == "2026-05-01" and str(row.last_checked_at) == "2026-05-20"


STATEFUL = {"stream_ingest", "stream_upsert", "stream_recheck", "load_job", "page_flatten", "stream_recheck_days", "load_rerun",
            "quarantine_report", "csv_mixed_headers", "load_processed", "stream_sightings", "page_flatten_all"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STATEFUL))
def test_plan_has_no_python_or_nested_loop(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in plan, (name, bad)
