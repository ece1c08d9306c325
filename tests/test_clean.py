"""Clean job: field cleaning, category exclusion, type mapping (FIXTURES 1, 2, 4)."""

from pyspark.sql import functions as F

from letwise.operators.clean import (
    build_mapping,
    category_purge,
    clean_listings,
    exclude_categories,
    mapping_dimension,
    standardise_type,
)
from letwise.sources.files import read_mapping_csv

RAW_SCHEMA = ("ads_id string, monthly_rent string, size string, category_id string, property_type string, "
              "publishedDatetime string, state string")
RAW_ROWS = [
    ("a1", "RM 740 per month", "615 sq.ft.", "House, For rent", "Apartment", "2024-11-30 07:45", "Eastland"),
    ("a2", "RM 13,900 per month", "2,340 sq.ft.", "Room, For rent", "Condominium", "31/12/2024", "Harbour"),
    ("a3", None, None, None, "Others", None, None),
    ("a4", "on request", "large", "", None, "2024-11-30 27:45", "Harbour"),
]


def test_clean_frame(spark):
    df = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    out = clean_listings(df, mapping_dimension(spark)).orderBy("ads_id").collect()
    assert len(out) == 4
    assert [r.monthly_rent for r in out] == [740.0, 13900.0, None, None]
    assert [r.size for r in out] == [615.0, 2340.0, None, None]
    assert [r.category_id for r in out] == ["House", "Room", "", ""]
    assert [r.publishedDatetime for r in out] == ["11/30/2024", "12/31/2024", "", ""]
    assert [r.CPI for r in out] == ["Apartment", "Condominium", "Other", "Other"]
    # the input frame is not modified
    assert df.orderBy("ads_id").first().monthly_rent == "RM 740 per month"


def test_category_exclusion_keeps_room_and_missing(spark):
    df = spark.createDataFrame([(c,) for c in ["Commercial Property, For rent", "Land, For rent", "Room, For rent",
                                               None, "", "House, For rent"]], "category_id string")
    got = sorted(r[0] for r in exclude_categories(df).collect())
    assert got == ["", "", "House", "Room"]


def test_all_null_rows_dropped(spark):
    df = spark.createDataFrame([(None, None), ("1", None)], "ads_id string, monthly_rent string")
    assert clean_listings(df).count() == 1


def test_mapping_newline_keys_last_wins(spark):
    df = spark.createDataFrame([
        ("Apartment", "Apartment", 0),
        ("Condo\nCondominium", "Condominium", 1),
        (None, "Ignored", 2),
        ("Flat", None, 3),
        ("Studio", "Apartment", 4),
        ("Studio", "Studio Unit", 5),
        ("  Duplex  ", "Apartment", 6),
        ("\n", "Blank", 7),
    ], "raw string, std string, _row long")
    m = {r.key: r.std for r in build_mapping(df, "_row").collect()}
    assert m == {"Apartment": "Apartment", "Condo": "Condominium", "Condominium": "Condominium",
                 "Studio": "Studio Unit", "Duplex": "Apartment"}


def test_type_standardise_defaults(spark):
    df = spark.createDataFrame([(t,) for t in ["Apartment", " Service Residence ", "apartment", "Penthouse", "", None]],
                               "property_type string")
    out = [r.CPI for r in standardise_type(df, mapping_dimension(spark)).collect()]
    assert out == ["Apartment", "Condominium", "Other", "Other", "Other", "Other"]


def test_mapping_csv_reader(spark, tmp_path):
    p = tmp_path / "mapping.csv"
    p.write_text('Raw Type,Standard Type\nApartment,Apartment\n"Condo\nCondominium",Condominium\n,Orphan\nFlat,Apartment\n')
    m = {r.key: r.std for r in build_mapping(read_mapping_csv(spark, str(p)), "_row").collect()}
    assert m == {"Apartment": "Apartment", "Condo": "Condominium", "Condominium": "Condominium", "Flat": "Apartment"}


def test_category_purge(spark):
    df = spark.createDataFrame([("1", "Land"), ("2", "Room"), ("3", None), ("4", "Commercial Property")],
                               "ads_id string, category_id string")
    assert sorted(r[0] for r in category_purge(df).collect()) == ["2", "3"]


def test_clean_plan_has_no_python(spark):
    df = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    plan = clean_listings(df, mapping_dimension(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan
