"""Availability: due selection, probe outcomes, re-check transition, snapshot diff (FIXTURES 8)."""

import datetime as dt

from pyspark.sql import functions as F

from letwise.operators.availability import (
    apply_snapshot,
    availability_summary,
    due_listings,
    probe_counters,
    probe_outcomes,
    recheck,
    recheck_by_day,
    snapshot_diff,
)

TABLE = ("ads_id string, first_seen date, last_checked_at date, ad_expiry string, availability_status string, "
         "gone_at date, state string")
D = dt.date


def table(spark):
    return spark.createDataFrame([
        ("gone1", D(2026, 5, 1), None, "2099-01-01 00:00:00", "active", None, "s1"),
        ("alive1", D(2026, 5, 1), None, "2099-01-01 00:00:00", "active", None, "s1"),
        ("rented1", D(2026, 5, 1), None, "2099-01-01 00:00:00", "rented", D(2026, 5, 20), "s2"),
        ("failed1", D(2026, 5, 1), None, "2026-05-20 00:00:00", "active", None, "s2"),
        ("expired1", D(2026, 5, 1), D(2026, 5, 20), "2026-05-20 00:00:00", None, None, "s2"),
        ("notdue1", D(2026, 5, 30), D(2026, 6, 1), "2099-01-01 00:00:00", "active", None, "s1"),
    ], TABLE)


def outcomes(spark):
    return spark.createDataFrame([("gone1", "gone"), ("alive1", "alive"), ("rented1", "gone"),
                                  ("failed1", "unknown"), ("expired1", "gone"), ("notdue1", "gone")],
                                 "ads_id string, outcome string")


def test_recheck_end_to_end(spark):
    out = {r.ads_id: r for r in recheck(table(spark), outcomes(spark), "2026-06-01").collect()}
    today = D(2026, 6, 1)
    assert (out["gone1"].availability_status, out["gone1"].gone_at, out["gone1"].last_checked_at) == ("rented", today, today)
    assert (out["alive1"].availability_status, out["alive1"].gone_at, out["alive1"].last_checked_at) == ("active", None, today)
    assert out["rented1"].gone_at == D(2026, 5, 20) and out["rented1"].last_checked_at is None
    assert out["failed1"].availability_status == "active" and out["failed1"].last_checked_at is None  # T19
    assert out["expired1"].availability_status == "expired"   # NULL status is non-terminal
    assert out["notdue1"].availability_status == "active"      # not due: probe ignored


def test_recheck_with_limit(spark):
    out = {r.ads_id: r for r in recheck(table(spark), outcomes(spark), "2026-06-01", limit=1).collect()}
    changed = sorted(k for k, r in out.items() if r.last_checked_at == D(2026, 6, 1) and k != "notdue1")
    assert changed == ["alive1"]   # never checked first, then by id: alive1 < failed1 < gone1


def test_only_open_rows_are_joined(spark, tmp_path):
    """The listings that no probe can change are read into a branch of their own, beside the join."""
    t = table(spark)
    more = t.unionByName(t.where("ads_id = 'rented1'")).unionByName(t.where("ads_id = 'gone1'").withColumn("ads_id", F.lit(None).cast("string")))
    more.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    out = recheck(stored, outcomes(spark), "2026-06-01")
    assert out.count() == 8 and out.where("ads_id = 'rented1'").count() == 2 and out.where("ads_id is null").count() == 1
    log = spark.createDataFrame([("gone1", dt.datetime(2026, 6, 1, 9), True, 0)], PROBES)
    for joined in (out, recheck_by_day(stored, log)):
        plan = joined._jdf.queryExecution().optimizedPlan()
        assert plan.nodeName() == "Union"
        assert sorted("Join" in plan.children().apply(i).toString() for i in range(2)) == [False, True]


def test_due_listings_order_and_cap(spark):
    due = [r.ads_id for r in due_listings(table(spark), "2026-06-01", limit=10).collect()]
    assert due == ["alive1", "failed1", "gone1", "expired1"]
    assert due_listings(table(spark), "2026-06-01").count() == 4
    assert due_listings(table(spark), "2026-06-01", limit=0).count() == 4


def test_probe_outcomes_latest_wins(spark):
    log = spark.createDataFrame([
        ("a", dt.datetime(2026, 6, 1, 9), True, 1), ("a", dt.datetime(2026, 6, 1, 10), True, 0),
        ("b", dt.datetime(2026, 6, 1, 9), True, 1), ("b", dt.datetime(2026, 6, 1, 10), False, None),
        ("c", dt.datetime(2026, 6, 1, 9), True, 2),
    ], "ads_id string, checked_at timestamp, http_ok boolean, n_items long")
    out = {r.ads_id: r.outcome for r in probe_outcomes(log).collect()}
    assert out == {"a": "gone", "b": "unknown", "c": "alive"}


def test_snapshot_diff_with_failed_slice(spark):
    t = spark.createDataFrame([("1", "s1", "active"), ("2", "s1", "active"), ("3", "s2", "active"),
                               ("4", "s1", "rented")], "ads_id string, state string, availability_status string")
    fresh = spark.createDataFrame([("1", "s1"), ("9", "s1")], "ads_id string, state string")
    done = spark.createDataFrame([("s1",)], "state string")
    out = {r.ads_id: r.diff for r in snapshot_diff(t, fresh, done, ["state"]).collect()}
    assert out == {"1": "present", "2": "absent", "3": "unverified"}
    done = spark.createDataFrame([("s1",), ("s2",), ("s2",)], "state string")
    out2 = {r.ads_id: r.diff for r in snapshot_diff(t, fresh, done, ["state"]).collect()}
    assert out2 == {"1": "present", "2": "absent", "3": "absent"}
    none = {r.ads_id: r.diff for r in snapshot_diff(t, fresh, done.limit(0), ["state"]).collect()}
    assert none == {"1": "present", "2": "unverified", "3": "unverified"}   # having rows of a slice proves nothing


def test_snapshot_applied(spark):
    diff = spark.createDataFrame([("gone1", "absent"), ("alive1", "present"), ("expired1", "unverified"), ("notdue1", "present")],
                                 "ads_id string, diff string")
    moved, probes = apply_snapshot(table(spark), diff, "2026-05-25")
    out = {r.ads_id: r.last_checked_at for r in moved.collect()}
    assert out["alive1"] == D(2026, 5, 25) and out["expired1"] == D(2026, 5, 20) and out["gone1"] is None
    assert out["notdue1"] == D(2026, 6, 1)                                    # never back
    assert [r.ads_id for r in probes.collect()] == ["gone1"]


PROBES = "ads_id string, checked_at timestamp, http_ok boolean, n_items long"


def test_recheck_by_day_is_the_same_in_one_batch_or_several(spark):
    at = lambda m, d, h=9: dt.datetime(2026, m, d, h)
    log = [("gone1", at(6, 1), True, 1), ("gone1", at(6, 20), True, 0), ("gone1", at(6, 25), True, 1), ("alive1", at(6, 1), True, 3),
           ("alive1", at(6, 2), True, 0), ("failed1", at(6, 1), False, 0), ("failed1", at(6, 3), None, 1), ("rented1", at(6, 1), True, 0),
           ("expired1", at(6, 20), True, 0), (None, at(6, 1), True, 0), ("notdue1", None, True, 0), ("unknown", at(6, 1), True, 1)]
    whole = sorted(map(tuple, recheck_by_day(table(spark), spark.createDataFrame(log, PROBES)).collect()), key=repr)
    t = table(spark)
    for day in sorted({r[1] for r in log if r[1]}):
        t = recheck_by_day(t, spark.createDataFrame([r for r in log if r[1] == day], PROBES))
    assert sorted(map(tuple, t.collect()), key=repr) == whole
    out = {r[0]: r for r in whole}
    assert out["gone1"][2:] == (D(2026, 6, 20), "2099-01-01 00:00:00", "rented", D(2026, 6, 20), "s1")
    assert out["alive1"][2] == D(2026, 6, 1) and out["alive1"][4] == "active"   # not due the day after
    assert out["failed1"][2] is None and out["rented1"][5] == D(2026, 5, 20) and out["expired1"][4] == "expired"


def test_probe_counters(spark):
    log = spark.createDataFrame([("a", dt.datetime(2026, 6, 1, 9), True, 1), ("b", dt.datetime(2026, 6, 1, 9), True, 0),
                                 ("c", dt.datetime(2026, 6, 1, 9), None, 1), ("d", dt.datetime(2026, 6, 2, 9), True, None)], PROBES)
    assert sorted(map(tuple, probe_counters(log).collect())) == [(D(2026, 6, 1), 1, 1, 1), (D(2026, 6, 2), 0, 1, 0)]


def test_availability_summary(spark):
    out = {r.state: tuple(r)[1:] for r in availability_summary(table(spark)).collect()}
    assert out == {"s1": (3, 3, 0, 0), "s2": (3, 2, 1, 0)}
