"""Coordinate lookup and backfill (FIXTURES 9), duplicates in the coordinate table."""

import pytest

from letwise.operators.geo import backfill_coordinates, bbox_report, lookup_coordinates, pairs_to_fill

TABLE = "ads_id string, region string, state string, latitude double, longitude double"
GEO = "query string, lat double, lon double"


def data(spark):
    t = spark.createDataFrame([
        ("hit_both", "Northfield", "Eastland", None, None),
        ("region_miss", "Nowhere", "Eastland", None, None),
        ("region_null", None, "Eastland", None, None),
        ("region_blank", "", "Eastland", None, None),
        ("state_null", "Northfield", None, None, None),
        ("lon_only", "Northfield", "Eastland", 9.0, None),
        ("negative", "Ghost", "Harbour", None, None),
        ("complete", "Northfield", "Eastland", 1.0, 2.0),
        ("no_state_hit", "X", "Atlantis", None, None),
    ], TABLE)
    g = spark.createDataFrame([
        ("Northfield, Eastland, Malaysia", 3.07, 101.52),
        ("Eastland, Malaysia", 3.5, 101.5),
        ("Ghost, Harbour, Malaysia", None, None),
        ("Harbour, Malaysia", 5.4, 100.3),
    ], GEO)
    return t, g


@pytest.mark.parametrize("times", [1, 3])
def test_backfill(spark, times):
    t, g = data(spark)
    for _ in range(times - 1):  # queries repeat in the coordinate table, with misses and smaller pairs among them
        g = g.union(g.selectExpr("query", "lat - 1", "lon - 1")).union(g.selectExpr("query", "cast(null as double)", "cast(null as double)"))
    rows = backfill_coordinates(t, g).collect()
    assert len(rows) == t.count()
    out = {r.ads_id: (r.latitude, r.longitude) for r in rows}
    assert out == {
        "hit_both": (3.07, 101.52),
        "region_miss": (3.5, 101.5),
        "region_null": (3.5, 101.5),
        "region_blank": (3.5, 101.5),
        "state_null": (None, None),
        "lon_only": (3.07, 101.52),
        "negative": (5.4, 100.3),
        "complete": (1.0, 2.0),
        "no_state_hit": (None, None),
    }


def test_pairs_to_fill_distinct(spark):
    t, _ = data(spark)
    assert pairs_to_fill(t).count() == 7   # lon_only shares its pair with hit_both


def test_lookup_blank_query(spark):
    _, g = data(spark)
    df = spark.createDataFrame([("1", "Eastland, Malaysia"), ("2", ""), ("3", "Unknown, Malaysia")], "ads_id string, q string")
    rows = lookup_coordinates(df, "q", g.union(g)).collect()
    assert len(rows) == 3
    out = {r.ads_id: (r.latitude, r.longitude) for r in rows}
    assert out == {"1": (3.5, 101.5), "2": (None, None), "3": (None, None)}


def test_bbox(spark):
    df = spark.createDataFrame([("a", 3.0, 101.0), ("a", 30.0, 101.0), ("a", None, 1.0)],
                               "state string, latitude double, longitude double")
    r = bbox_report(df).first()
    assert (r.n_with_coords, r.n_outside, r.n_missing) == (2, 1, 1)
