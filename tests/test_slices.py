"""Slice selection (W7), state validation (W8), dimensions (J9) and the coordinate table."""

import pytest
from pyspark.sql import functions as F

from letwise.operators.slices import (
    region_dimension,
    select_slices,
    type_dimension,
    unknown_states,
    validate_states,
    with_slice_names,
)
from letwise.session import scratch_path
from letwise.sources.files import read_geo, write_geo


def frame(spark):
    return spark.createDataFrame([("1", " Selangor ", "2"), ("2", "penang", "41"), ("3", "Johor", "2")],
                                 "ads_id string, state string, property_type_id string")


def test_select_slices(spark):
    df = frame(spark)
    assert sorted(r.ads_id for r in select_slices(df, states=["selangor", "Johor"]).collect()) == ["1", "3"]
    assert [r.ads_id for r in select_slices(df, type_ids=[41]).collect()] == ["2"]
    assert select_slices(df).count() == 3


def test_validate_states(spark):
    validate_states(frame(spark))
    bad = frame(spark).union(spark.createDataFrame([("4", "Atlantis", "2")], "ads_id string, state string, property_type_id string"))
    assert [r.state_key for r in unknown_states(bad).collect()] == ["atlantis"]
    with pytest.raises(ValueError, match="atlantis"):
        validate_states(bad)


def test_dimensions(spark):
    assert region_dimension(spark).count() == 16
    t = type_dimension(spark)
    assert t.count() == 29 and t.where("type_id = 44").first().type_name == "Shoplot"


def test_slice_names_keep_every_row(spark):
    schema = "ads_id string, state string, property_type_id string, type_name string"
    rows = spark.createDataFrame([("1", " Johor ", "44", "old"), ("2", "atlantis", " 44 ", "old"), ("3", None, None, "old"),
                                  ("4", "johor", "9999", "old"), ("4", "johor", "9999", "old"), ("5", "", "", None)], schema)
    out = with_slice_names(rows)
    assert out.columns == ["ads_id", "state", "property_type_id", "region_code", "type_name"]
    code = region_dimension(spark).where("state_key = 'johor'").first().region_code
    assert sorted((r.ads_id, r.region_code, r.type_name) for r in out.collect()) == [
        ("1", code, "Shoplot"), ("2", None, "Shoplot"), ("3", None, None), ("4", code, None), ("4", code, None), ("5", None, None)]
    assert with_slice_names(rows.limit(0)).count() == 0


def test_geo_table_roundtrip_one_row_per_query(spark):
    path = scratch_path(spark, "geo")
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.5, 2.5), ("b", None, None)], "query string, lat double, lon double")
    write_geo(df, path)
    out = {r.query: (r.lat, r.lon) for r in read_geo(spark, path).collect()}
    assert out == {"a": (1.5, 2.5), "b": (None, None)}
