"""Rent statistics: exact medians in two steps, exact means, rents left out."""

import random
from math import isclose
from statistics import median

from letwise.operators.audits import completed_slices, rent_summary, slice_coverage, slice_totals


def test_rent_summary_is_exact(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None, "c"]), rnd.choice([None, -5.0, 0.0, 0.004, 1200.0, 1200.5, rnd.random() * 10 ** rnd.randint(0, 12)]))
            for _ in range(3000)] + [("only null", None), ("one", 7.25), ("two", 1.0), ("two", 2.0)]
    out = {r.state: r for r in rent_summary(spark.createDataFrame(rows, "state string, monthly_rent double").repartition(5)).collect()}
    assert set(out) == {s for s, _ in rows}
    for s, r in out.items():
        held = [x for t, x in rows if t == s and x is not None]
        assert (r.n_listings, r.n_rent) == (sum(t == s for t, _ in rows), len(held))
        assert r.median_rent is None if not held else isclose(r.median_rent, median(held), rel_tol=1e-15, abs_tol=1e-300)
        assert (r.mean_rent is None) if not held else abs(r.mean_rent - sum(held) / len(held)) <= 1e-9 * max(1, abs(r.mean_rent))


def test_huge_rents_do_not_fail(spark):
    df = spark.createDataFrame([("a", 1e20), ("a", 1e30), ("a", 0.004)], "state string, monthly_rent double")
    r = rent_summary(df, left_out=True).first()
    assert (r.n_rent, r.n_left_out, r.median_rent) == (3, 1, 1e20) and r.mean_rent == 5e19
    assert rent_summary(df.limit(0)).count() == 0


def test_rent_summary_plan(spark):
    df = spark.createDataFrame([("a", 1.0)], "state string, monthly_rent double")
    assert "ObjectHashAggregate" not in rent_summary(df)._jdf.queryExecution().executedPlan().toString()


def test_slices(spark):
    reported = spark.createDataFrame([("r", "x", 3), ("r", "y", 2), ("q", "z", 4), ("r", "w", 0)], "region string, slice string, total_results long")
    fetched = spark.createDataFrame([("r", "x")] * 3 + [("r", "y"), ("q", "z")], "region string, slice string")
    cov = slice_coverage(reported, fetched, ["region", "slice"])
    assert [r.slice for r in completed_slices(cov).collect()] == ["x"]
    assert {r.slice: r.sane for r in slice_totals(cov, ["region"]).collect()} == {"x": True, "y": True, "z": True, "w": False}
