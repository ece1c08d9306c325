"""Scalar column functions (F1-F11, P2-P6, P11) with the reference's cases and traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from letwise import functions as LF


def one(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_rent_reference_cases(spark):
    got = one(spark, LF.clean_rent, ["RM 1,200 per month", "RM 2,500 per month", "RM 800 per month",
                                     None, "invalid", "", "1500.0"])
    assert got == [1200.0, 2500.0, 800.0, None, None, None, 1500.0]


def test_clean_rent_traps(spark):
    # T7 glued prefix, T5 java suffix / spaces / nan / inf / underscores, exponent
    got = one(spark, LF.clean_rent, ["RM1,200", "1200d", " 12 ", "nan", "inf", "1_000", "1e3", ".5", "-3"])
    assert got == [None, None, 12.0, None, None, None, 1000.0, 0.5, -3.0]


def test_clean_rent_numeric_input(spark):
    assert one(spark, LF.clean_rent, [1500.0, None], "double") == [1500.0, None]


def test_clean_size(spark):
    got = one(spark, LF.clean_size, ["850 sq.ft.", "1,200 sq.ft.", None, "unknown", "900.0", "719 sq.m."])
    assert got == [850.0, 1200.0, None, None, 900.0, None]


def test_clean_rooms(spark):
    got = one(spark, LF.clean_rooms, ["3", "3.0", "4.0", "More than 10", None, "", "3.7", "-0.5", " Studio ", "inf", "nan"])
    assert got == ["3", "3", "4", "More than 10", None, None, "3", "0", "Studio", "inf", "nan"]


def test_strip_category(spark):
    got = one(spark, LF.strip_category, ["Apartment / Condominium, For rent", "Room, For rent", None, "",
                                         "House, For rent, For rent"])
    assert got == ["Apartment / Condominium", "Room", "", "", "House"]


def test_publish_date_order_free(spark):
    # ISO input parsed per row, whatever the first row is
    got = one(spark, LF.publish_date, ["2025-01-01 10:00", "2025-02-15 12:30", None, "bad-date",
                                       "2026-05-13", "2026-05-02 20:10:31", "13/05/2026", "02/05/2026 08:00"])
    assert got == ["01/01/2025", "02/15/2025", "", "", "05/13/2026", "05/02/2026", "05/13/2026", "05/02/2026"]


def test_parse_day_prefix(spark):
    got = one(spark, LF.parse_day, ["2026-05-31 10:00", "2026-05-31", "garbage", None, "", "2026", "2026-6-1"])
    assert got == [dt.date(2026, 5, 31), dt.date(2026, 5, 31), None, None, None, None, None]


@pytest.mark.parametrize("first_seen,last,due", [
    ("2026-05-30", None, True),
    ("2026-05-30", "2026-06-01", False),
    ("2026-05-30", "2026-05-31", True),
    ("2026-05-22", "2026-05-30", False),
    ("2026-05-22", "2026-05-29", True),
    ("2026-04-22", "2026-05-27", False),
    ("2026-04-22", "2026-05-25", True),
    (None, "2026-06-01", False),
    (None, "2026-05-31", True),
    # extra: ages exactly 7 and 21 move to the next bucket
    ("2026-05-25", "2026-05-30", False),   # age 7 -> interval 3, 2 days since
    ("2026-05-25", "2026-05-29", True),    # 3 days since
    ("2026-05-11", "2026-05-26", False),   # age 21 -> interval 7, 6 days since
    ("2026-05-11", "2026-05-25", True),
    ("2026-07-01", "2026-05-31", True),    # future first_seen -> youngest bucket
    ("2026-05-30", "garbage", True),       # bad check date -> due
    ("2026-05-30", "", True),              # blank -> never checked
    ("2026-05-30", "2026-05-31 10:00", True),
    ("2026-05-30", "2026-06-01 10:00", False),
])
def test_due_for_check(spark, first_seen, last, due):
    df = spark.createDataFrame([(first_seen, last)], "f string, l string")
    assert df.select(LF.due_for_check("f", "l", "2026-06-01")).first()[0] is due


def test_recheck_interval_from_policy(spark):
    df = spark.createDataFrame([(a,) for a in (-3, 0, 6, 7, 20, 21, 400)], "a int")
    assert [r[0] for r in df.select(LF.recheck_interval("a")).collect()] == [1, 1, 1, 3, 3, 7, 7]


def test_classify_gone(spark):
    got = one(spark, lambda c: LF.classify_gone(c, "2026-06-01"),
              ["2026-07-07 18:42:56", "2026-05-20 10:00:00", None, "", "not-a-date", "2026-06-01 23:00:00", "2026-07-07"])
    assert got == ["rented", "expired", "expired", "expired", "expired", "expired", "expired"]


def test_list_or_scalar_text(spark):
    got = one(spark, LF.list_or_scalar_text, ['["Condominium","Duplex"]', "Studio", None, "[1,2]", "[broken"])
    assert got == ["Condominium, Duplex", "Studio", "", "1, 2", "[broken"]


def test_labels(spark):
    df = spark.createDataFrame([("RM 2,000", "719", "sq.ft.", "Room"), ("", "0", "sq.ft.", None),
                                (None, None, None, ""), ("RM 1", "800", None, "House")],
                               "p string, s string, x string, c string")
    out = df.select(LF.rent_label("p"), LF.size_label("s", "x"), LF.category_label("c")).collect()
    assert [tuple(r) for r in out] == [
        ("RM 2,000 per month", "719 sq.ft.", "Room, For rent"),
        ("", "", ""),
        ("", "", ""),
        ("RM 1 per month", "800", "House, For rent"),
    ]


def test_address_and_geocode_query(spark):
    df = spark.createDataFrame([
        ("Quarry Court", "Northfield", "Eastland"),
        ("", " Northfield ", "Eastland"),
        (None, None, "Eastland"),
        ("  ", None, None),
    ], "b string, s string, r string")
    out = df.select(LF.address("b", "s", "r"), LF.geocode_query("b", "s", "r")).collect()
    assert [tuple(r) for r in out] == [
        ("Quarry Court, Northfield, Eastland", "Quarry Court, Northfield, Eastland, Malaysia"),
        (" Northfield , Eastland", "Northfield, Eastland, Malaysia"),
        ("Eastland", "Eastland, Malaysia"),
        ("", ""),
    ]


def test_first_present(spark):
    df = spark.createDataFrame([("2026-05-02", "2026-05-01"), ("", "2026-05-01"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(LF.first_present("a", "b")).collect()] == ["2026-05-02", "2026-05-01", ""]


def test_slug(spark):
    got = one(spark, LF.slug, ["2.5-storey Terraced House", "  Condo / Services residence / Penthouse / Townhouse ",
                               "___", "Café Lot"])
    assert got == ["2_5_storey_terraced_house", "condo_services_residence_penthouse_townhouse", "type", "café_lot"]


def test_na_tokens(spark):
    got = one(spark, LF.na_to_null, ["None", "NA", "n/a", "nan", "", "Studio", " null "])
    assert got == [None, None, None, None, None, "Studio", " null "]


def test_json_attribute(spark):
    got = one(spark, lambda c: LF.json_attribute(c, "k"), ['{"k": 69}', '{"j": 1}', "not json", None])
    assert got == ["69", None, None, None]
