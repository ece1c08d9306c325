"""Sharding, ranked search and hard negatives against brute force, and their edge inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from letwise.llm import lexical, negatives, sharding

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --------------------------------------------------------------------------- sharding
def drawn(key, shard, weight):
    bits = int(hashlib.md5(f"{key}/{shard}".encode()).hexdigest()[:13], 16)
    return -math.log((bits + 0.5) / 2**52) / weight


def shard_of(key, weights):
    return min(range(len(weights)), key=lambda s: (drawn(key, s, weights[s]), s))


def test_place_equals_rendezvous_by_hand(spark):
    weights = (1.0, 2.0, 0.5)
    rows = sharding.place(spark.range(300).withColumnRenamed("id", "doc_id"), weights=weights, grown_weight=1.5).collect()
    for r in rows:
        assert r.shard == shard_of(r.doc_id, weights)
        assert r.grown_shard == shard_of(r.doc_id, (*weights, 1.5))


def test_one_more_shard_takes_rows_only_into_itself(spark):
    rows = sharding.place(spark.range(20000).withColumnRenamed("id", "doc_id")).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert all(r.grown_shard == 8 for r in moved) and abs(len(moved) / len(rows) - 1 / 9) < 0.01
    assert all(abs(n / len(rows) - 1 / 8) < 0.015 for n in Counter(r.shard for r in rows).values())
    grown = sharding.place(spark.range(20000).withColumnRenamed("id", "doc_id"), weights=(1.0,) * 9, grown_weight=None)
    assert {r.doc_id: r.shard for r in grown.collect()} == {r.doc_id: r.grown_shard for r in rows}
    assert grown.where("grown_shard is not null").count() == 0


def test_weights_share_the_rows(spark):
    n = Counter(r.shard for r in sharding.place(spark.range(20000).withColumnRenamed("id", "doc_id"), weights=(1, 3), grown_weight=None).collect())
    assert abs(n[1] / 20000 - 0.75) < 0.01
    with pytest.raises(ValueError):
        sharding.place(spark.range(1), key="id", weights=(1, 0))


def test_slots_are_gapless_with_a_hot_key_and_odd_rows(spark):
    rows = [(7, "x", "a")] * 400 + [(i, f"t{i}", "b") for i in range(500)] + [(None, None, None), (None, "", "c"), (7, "y" * 5000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot string").withColumn("Shard", F.lit("mine")).repartition(5)
    placed = sharding.number(sharding.place(sharding.measure(docs)), ties=("size", "text_crc32"), range_rows=100)
    got = placed.collect()
    assert len(got) == len(rows) and placed.columns.count("slot") == 1 and "Shard" not in placed.columns
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    for r in got:
        text = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    order = sorted((r for r in got if r.shard == got[0].shard), key=lambda r: r.slot)
    digests = [hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest() for r in order]
    assert digests == sorted(digests)


def test_sharding_of_an_empty_table_and_written_shards(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.number(sharding.place(sharding.measure(empty))).count() == 0
    placed = sharding.number(sharding.place(spark.range(1000).withColumnRenamed("id", "doc_id")))
    sharding.write_shards(placed, str(tmp_path / "shards"), rows_per_file=50)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, placed.select("doc_id", "shard", "slot").collect()))
    assert len(list((tmp_path / "shards" / "shard=0").glob("*.parquet"))) > 1


# --------------------------------------------------------------------------- ranked search
def ranked(docs, items, k=50):
    terms = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t is not None]
    terms = [(i, c) for i, c in terms if c]
    n, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in terms:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(int(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if t in c)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(seed, n=300, words=60, same_length=0.4):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(40)] + ["Äpfel", "naïve", "日本", "X9"]
    out = []
    for i in range(n):
        size = 30 if rng.random() < same_length else int(rng.integers(1, words))
        out.append((int(i), " ".join(vocab[int(x) % len(vocab)] for x in rng.zipf(1.4, size))))
    return out


@pytest.mark.parametrize("seed,block,slices", [(1, 2_000_000, 4 << 20), (2, 200, 4 << 20), (3, 500, 60)])
def test_ranks_equal_brute_force(spark, monkeypatch, seed, block, slices):
    monkeypatch.setattr(lexical, "build_index", lambda *a, f=lexical.build_index, **b: f(*a, block_postings=block, **b))
    monkeypatch.setattr(lexical, "FIRST_DOCS", 4)
    docs = corpus(seed)
    items = [(i, docs[i * 7][1] + " w1 w39 unknown") for i in range(12)] + [(20, None), (21, "--"), (None, "w1"), (3, "w5 ÄPFEL")]
    got = lexical.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                 spark.createDataFrame(items, "item_id long, text string"), k=10, slice_bytes=slices)
    assert sorted(map(tuple, got.collect())) == ranked(docs, items, 10)


def test_odd_texts_and_queries(spark):
    docs = [(1, None), (2, ""), (3, "--- \x00\x7f"), (4, "one TWO two"), (4, "one TWO two"), (5, "two " * 30000), (None, "one two"), (6, "ONE\ttwo\nÉé_é2"), (7, "x@y")]
    items = [("a", "one two"), ("b", "éé É"), ("c", ""), ("d", "y x nothing")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("id", F.lit("q")).withColumn("terms", F.lit(0))
    got = lexical.rank_documents(frame, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(map(tuple, got.collect())) == ranked(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexical.rank_documents(empty, spark.createDataFrame(items, "item_id string, text string")).count() == 0
    assert lexical.rank_documents(frame, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_stratum_bounds_stop_early(spark):
    docs = [(i, "rare " * 5 if i < 60 else ("rare " if i < 2000 else "common ") + " ".join(["filler"] * (i % 97))) for i in range(3000)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"), ["common", "rare"])
    strata = lexical.Strata(index.strata.toArrow(), 2)
    ids, _, visited = strata.top(np.array([1]), index.weights()[1:], 50)
    assert ids.tolist() == list(range(50)) and visited < len(strata.doc_first) - 1


# --------------------------------------------------------------------------- hard negatives
def mined(rows, anchors, k=5, low=80):
    rows = [(i, lab, np.array(v, np.int64)) for i, lab, v in rows]
    out = []
    for i, lab, v in rows:
        if not anchors(i):
            continue
        scored = sorted((-int(v @ w), j, m) for j, m, w in rows if j != i and len(w) == len(v))
        for p, pid, _ in [x for x in scored if x[2] == lab][:k]:
            near = [x for x in scored if x[2] != lab and low * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(i, pid, r, j, -p, -s) for r, (s, j, _) in enumerate(near, 1)]
    return sorted(out)


def vectors(seed, n, dims=6, labels=3, copies=0):
    rng = np.random.default_rng(seed)
    hot = rng.integers(-9, 10, dims).tolist()
    return [(i, int(rng.integers(0, labels)), hot if i < copies else rng.integers(-9, 10, dims).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,n,copies,block,group", [(1, 400, 0, 8192, 16384), (2, 400, 150, 64, 5), (3, 300, 0, 50, 16384)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, n, copies, block, group):
    monkeypatch.setattr(negatives, "FIRST_CHUNK", 8)
    rows = vectors(seed, n, copies=copies)
    frame = spark.createDataFrame(rows, "id long, label long, v array<bigint>")
    got = negatives.mine(frame, frame.where("id % 10 = 0"), block_rows=block, anchor_rows=group)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (2, None, 0), (3, [1.0, None], 0), (4, [1.0, nan], 0), (5, [1.0, -inf], 0), (6, [1.0, 1.0], None),
            (None, [1.0, 1.0], 0), (7, [], 0), (8, [-0.5, 0.0], 1), (8, [-0.5, 0.0], 1), (8, [0.5, 0.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    got = negatives.labelled_vectors(frame.drop("id", "v"), scale=2)
    assert sorted((r.id, r.label, r.v) for r in got.collect()) == [(1, 0, [2, 4]), (8, 0, [1, 0])]
    assert negatives.mine(got.limit(0), got.limit(0)).count() == 0


def test_mixed_dimensions_and_zero_vectors(spark):
    rows = vectors(5, 120) + [(200 + i, lab, v) for i, lab, v in vectors(6, 60, dims=3)] + [(300, 0, [0] * 6), (310, 1, [0] * 6)]
    frame = spark.createDataFrame(rows, "id long, label long, v array<bigint>")
    got = negatives.mine(frame, frame.where("id % 10 = 0"))
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0)


def test_walk_stops_when_certified():
    rng = np.random.default_rng(4)
    centre = np.eye(8)[0]
    close, far = centre + 0.01 * rng.normal(size=(50, 8)), rng.normal(size=(5000, 8)) * [0.01, 1, 1, 1, 1, 1, 1, 1]
    data = np.round(np.vstack([close, far / 9]) * 256)
    import pandas as pd
    block = negatives.Block(pd.DataFrame({"id": range(len(data)), "label": 0, "v": list(data.astype(int))}))
    members = np.round((centre + 0.01 * rng.normal(size=(3, 8))) * 256)
    (own, listed, bound), = block.shared_lists(members, centre[None, :])
    for a in own:
        ids, scores, read = negatives.walk(listed, bound, members[a], lambda i, lab, s: negatives.first(i, s, np.arange(len(s)), 5),
                                           lambda s: s[-1] if len(s) == 5 else -np.inf)
        exact = data @ members[a]
        assert ids.tolist() == np.lexsort((np.arange(len(data)), -exact))[:5].tolist() and read < len(data) / 4
