"""The tables kept between loads: by state (S7, M1, M5) and by bucket."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import schemas as S
from letwise.operators.dedup import content_dedup
from letwise.operators.upsert import upsert
from letwise.plans import state_load
from letwise.plans.state_load import merge_states, recheck_states, untouched
from letwise.sources.buckets import create, merge_buckets, merged_buckets, read_buckets
from letwise.sources.states import HASH, PART, empty_part, read_states, read_stored

BATCH = "ads_id string, monthly_rent double, state string, rooms string, scrape_date string"


def rows_of(df):
    return sorted(map(tuple, df.select(*S.TABLE_COLUMNS).collect()), key=str)


def files(root):
    return {p: os.stat(p).st_ino for p in glob.glob(f"{root}/{PART}=*/*.parquet")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def batches(spark):
    """New listings, repeated content, moved listings, content that changes back, a listing without a state."""
    one = [(str(i), float(i % 7), ["Johor", "Kedah", "", None][i % 4], str(i % 3), "2026-05-01") for i in range(120)]
    two = [(str(i), float(i % 5), ["Kedah", "Perak"][i % 2], str(i % 3), "2026-05-02") for i in range(0, 160, 3)]
    three = [(str(i), float(i % 7), "Johor", str(i % 3), "2026-05-03") for i in range(0, 200, 7)] + [("5", 1.0, "Sabah", "1", "2026-04-01")]
    return [spark.createDataFrame(b, BATCH) for b in (one, two, three)]


def full_rule(loads):
    table = None
    for b in loads:
        table = content_dedup(upsert(table, b), K.CONTENT_DEDUP_COLUMNS)
    return table


def test_three_loads_equal_the_full_rule(spark, tmp_path):
    root = str(tmp_path / "t")
    loads = batches(spark)
    for i, b in enumerate(loads):
        merge_states(spark, b, root)
        assert rows_of(read_states(spark, root)) == rows_of(full_rule(loads[:i + 1]))
    again = merge_states(spark, loads[2], root)          # a replay changes nothing
    assert rows_of(read_states(spark, root)) == rows_of(full_rule(loads)) and again["batch_keys"] == loads[2].count()


def test_a_batch_rewrites_its_states_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    merge_states(spark, spark.createDataFrame([(str(i), float(i), f"S{i % 5}", "1", "2026-05-01") for i in range(50)], BATCH), root)
    before = files(root)
    done = merge_states(spark, spark.createDataFrame([("0", 9.5, "S0", "1", "2026-05-02"), ("101", 7.5, "S3", "1", "2026-05-02")], BATCH), root)
    after = files(root)
    same = {p for p in before if before[p] == after.get(p)}
    assert done["parts"] == ["s0", "s3"]
    assert {p.split(f"{PART}=")[1].split("/")[0] for p in same} == {"s1", "s2", "s4"}
    assert all(p in same for p in before if f"{PART}=s0/" not in p and f"{PART}=s3/" not in p)


def test_a_listing_that_moves_leaves_its_old_state(spark, tmp_path):
    root = str(tmp_path / "t")
    merge_states(spark, spark.createDataFrame([("1", 1.0, "Johor", "1", "2026-05-01"), ("2", 2.0, "Kedah", "1", "2026-05-01"),
                                               ("3", 3.0, "Kedah", "1", "2026-05-01")], BATCH), root)
    done = merge_states(spark, spark.createDataFrame([("2", 2.0, "Perak", "1", "2026-05-02")], BATCH), root)
    assert done["parts"] == ["kedah", "perak"] and done["emptied"] == []
    done = merge_states(spark, spark.createDataFrame([("1", 1.0, "Perak", "1", "2026-05-02")], BATCH), root)
    assert done["emptied"] == ["johor"]                  # its last listing left
    assert sorted((r.ads_id, r.state) for r in read_states(spark, root).collect()) == [("1", "Perak"), ("2", "Perak"), ("3", "Kedah")]
    assert read_states(spark, root, ["Johor"]).count() == 0
    merge_states(spark, spark.createDataFrame([("9", 1.0, "Johor", "1", "2026-05-03")], BATCH), root)
    assert [r.ads_id for r in read_states(spark, root, ["Johor"]).collect()] == ["9"]


def test_a_load_that_died_while_moving_folders_is_mended_by_a_rerun(spark, tmp_path):
    root = str(tmp_path / "t")
    move = spark.createDataFrame([("1", 1.0, "Perak", "1", "2026-05-02")], BATCH)
    merge_states(spark, spark.createDataFrame([("1", 1.0, "Johor", "1", "2026-05-01"), ("2", 2.0, "Johor", "1", "2026-05-01")], BATCH), root)
    old = read_stored(spark, root, ["johor"]).collect()
    merge_states(spark, move, root)
    whole = rows_of(read_states(spark, root))
    schema = read_stored(spark, root).schema
    spark.createDataFrame(old, schema).drop(PART).write.mode("overwrite").parquet(f"{root}/{PART}=johor")   # as if not replaced yet
    assert read_states(spark, root).count() == 3
    merge_states(spark, move, root)
    assert rows_of(read_states(spark, root)) == whole


def test_states_that_share_a_folder_and_odd_names(spark, tmp_path):
    root = str(tmp_path / "t")
    states = ["Kuala Lumpur", "kuala-lumpur", "123", "", None, "Ñ/=%", "type"]
    merge_states(spark, spark.createDataFrame([(str(i), float(i), s, "1", "2026-05-01") for i, s in enumerate(states)], BATCH), root)
    assert {r.ads_id: r.state for r in read_states(spark, root).collect()} == {str(i): s for i, s in enumerate(states)}
    assert [r.ads_id for r in read_states(spark, root, ["kuala-lumpur"]).collect()] == ["1"]
    assert [r.ads_id for r in read_states(spark, root, ["123"]).collect()] == ["2"]


def test_partition_filter_and_no_shuffle_of_untouched_groups(spark, tmp_path):
    root = str(tmp_path / "t")
    merge_states(spark, spark.createDataFrame([(str(i), float(i), f"S{i % 5}", "1", "2026-05-01") for i in range(500)], BATCH), root)
    stored = read_stored(spark, root, ["s1"])
    assert "PartitionFilters: [" in plan_of(stored) and f"{PART}#" in plan_of(stored).split("PartitionFilters: [")[1].split("]")[0]
    spark.createDataFrame([("1", 1)], f"ads_id string, {HASH} long").write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    ids, hashes = staged.select("ads_id"), staged.select(HASH).distinct()
    calm = untouched(stored, ids, hashes)
    calm.collect()
    plan = plan_of(calm)
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert not [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "ads_id" in line]


def test_empty_batch_and_missing_table(spark, tmp_path):
    root = str(tmp_path / "t")
    none = spark.createDataFrame([], BATCH)
    assert merge_states(spark, none, root)["parts"] == [] and read_states(spark, root).count() == 0
    merge_states(spark, spark.createDataFrame([("1", 1.0, "Johor", "1", "2026-05-01")], BATCH), root)
    before = files(root)
    assert merge_states(spark, none, root)["batch_keys"] == 0 and files(root) == before
    empty_part(spark, root, "johor")
    assert read_states(spark, root).count() == 0


def test_hot_content_and_hot_key(spark, tmp_path):
    root = str(tmp_path / "t")
    same = [(f"{i:05d}", 1.0, "Johor", "1", "2026-05-01") for i in range(2000)]
    merge_states(spark, spark.createDataFrame(same + [("k", float(i), "Kedah", "1", "2026-05-01") for i in range(1000)], BATCH).repartition(8), root)
    assert sorted((r.ads_id, r.monthly_rent) for r in read_states(spark, root).collect()) == [("00000", 1.0), ("k", 999.0)]


def test_recheck_rewrites_the_probed_states(spark, tmp_path):
    root = str(tmp_path / "t")
    merge_states(spark, spark.createDataFrame([(str(i), float(i), f"S{i % 3}", "1", "2026-05-01") for i in range(9)], BATCH), root)
    before = files(root)
    probes = spark.createDataFrame([("0", "2026-06-01 10:00:00", True, 0), ("3", "2026-06-01 11:00:00", True, 2), (None, None, True, 1)],
                                   "ads_id string, checked_at string, http_ok boolean, n_items long").withColumn("checked_at", F.to_timestamp("checked_at"))
    assert recheck_states(spark, probes, root) == {"parts": ["s0"], "probed": 2}
    once = rows_of(read_states(spark, root))
    assert {p for p in before if before[p] != files(root).get(p)} == {p for p in before if f"{PART}=s0/" in p}
    status = {r.ads_id: (r.availability_status, str(r.last_checked_at)) for r in read_states(spark, root).collect()}
    assert status["0"][0] != "active" and status["3"] == ("active", "2026-06-01") and status["1"] == ("active", "None")
    recheck_states(spark, probes, root)
    assert rows_of(read_states(spark, root)) == once
    assert recheck_states(spark, probes.limit(0), root) == {"parts": [], "probed": 0}


def test_streamed_probes_rewrite_only_their_states_and_are_counted(spark, tmp_path):
    from letwise.streaming.jobs import RECHECKS, read_counters, recheck_states_stream
    root, src = str(tmp_path / "t"), str(tmp_path / "probes")
    schema = "ads_id string, checked_at timestamp, http_ok boolean, n_items long"
    at = [dt.datetime(2026, 6, x, 9) for x in (1, 20)]
    first = [("0", at[0], True, 0), ("4", at[0], True, 2), ("nobody", at[0], True, 0), ("1", at[0], False, 0), (None, at[0], True, 1)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    with pytest.raises(Exception, match="no table"):
        recheck_states_stream(stream.parquet(src), root, str(tmp_path / "ck"))
    listings = [(str(i), float(i), f"S{i % 4}", "1", "2026-05-01") for i in range(40)]
    merge_states(spark, spark.createDataFrame(listings, BATCH), root)
    before = files(root)
    recheck_states_stream(stream.parquet(src), root, str(tmp_path / "ck"))
    changed = {p for p in before if before[p] != files(root).get(p)}
    assert changed == {p for p in before if f"{PART}=s0/" in p or f"{PART}=s1/" in p}
    once = rows_of(read_states(spark, root))
    recheck_states_stream(stream.parquet(src), root, str(tmp_path / "again"))     # the same probes by another checkpoint
    assert rows_of(read_states(spark, root)) == once
    spark.createDataFrame([("4", at[1], True, 0)], schema).coalesce(1).write.mode("append").parquet(src)
    recheck_states_stream(stream.parquet(src), root, str(tmp_path / "ck"))
    status = {r.ads_id: (r.availability_status, str(r.last_checked_at)) for r in read_states(spark, root).collect()}
    assert len(status) == 40 and status["0"][0] != "active" and status["4"] == (status["4"][0], "2026-06-20") != ("active", "2026-06-20")
    assert status["1"] == ("active", "None") and status["5"] == ("active", "None")
    got = read_counters(spark, root, RECHECKS).select("pulled", "alive", "gone", "failed", "probed", "parts").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, 0, 1, 1), (5, 2, 2, 1, 3, 2), (5, 2, 2, 1, 3, 2)]


@pytest.mark.parametrize("buckets", [3, 8])
def test_bucketed_merge_equals_the_upsert_and_moves_only_the_batch(spark, tmp_path, buckets):
    one, two, _ = batches(spark)
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    base = upsert(None, one)
    create(base, first, buckets)
    merged = merged_buckets(spark, first, buckets, two)
    assert rows_of(merged) == rows_of(upsert(base, two))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(merged_buckets(spark, first, buckets, two))
        merge_buckets(spark, first, second, buckets, two)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan.split("FileScan parquet")[0].split("SortMergeJoin")[1]     # what stands between the join and the table scan
    assert "Exchange" not in left and "Bucketed: true" in plan
    assert len(glob.glob(f"{second}/*.parquet")) == buckets
    assert rows_of(read_buckets(spark, second, buckets)) == rows_of(upsert(base, two))


def test_many_keys_are_shuffled_not_broadcast(spark, tmp_path, monkeypatch):
    """by the count of the keys, not by the size of their compressed file; the table is the same."""
    first = [(str(i), float(i % 7), f"S{i % 3}", "1", "2026-05-01") for i in range(60)]
    second = [(str(i), float(i % 5), f"S{i % 4}", "1", "2026-05-02") for i in range(30, 90)]
    tables = []
    for limit in (state_load.BROADCAST_ROWS, 10):
        monkeypatch.setattr(state_load, "BROADCAST_ROWS", limit)
        root = str(tmp_path / str(limit))
        done = [merge_states(spark, spark.createDataFrame(rows, BATCH), root) for rows in (first, second)]
        tables.append((done, sorted(map(str, read_states(spark, root).collect()))))
    assert tables[0] == tables[1]
    stored, keys = read_stored(spark, root), spark.read.parquet(str(tmp_path / "10")).select("ads_id").distinct()
    for rows, broadcast in ((10, True), (11, False)):
        held = stored.join(state_load.beside(keys, rows), "ads_id", "left_semi")
        held.collect()
        assert ("BroadcastHashJoin" in plan_of(held)) == broadcast and ("SortMergeJoin" in plan_of(held)) != broadcast
