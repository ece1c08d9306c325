"""Substring and suffix dedup, near-dedup and top-k against brute force on small fixtures."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from letwise.llm import near, recompress, suffixes, topk

DOCS = "doc_id long, text string, lang string, shard long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed=5, n=60):
    rnd = random.Random(seed)
    vocab = ["ab", "c", "dé", "the", "x,", "Ja", "ñu", "zz"]
    passages = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(15, 60))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            if rnd.random() < 0.4:
                p = rnd.choice(passages).split(" ")
                a = rnd.randint(0, len(p) // 3)
                parts.append(" ".join(p[a:a + rnd.randint(5, 50)]))
            else:
                parts.append(" ".join(rnd.choice(vocab) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(1, 30))))
        rows.append((i * 3, rnd.choice([" ", "\n", "  "]).join(parts), "en", 9))
    rows += [(500, rows[10][1], "en", 1), (501, rows[10][1], "de", 1), (502, None, "en", 1), (503, "", "en", 1),
             (504, "a" * 300, "en", 1), (505, "ab " * 80, "en", 1), (506, "word", "en", 1), (None, rows[12][1], "en", 1),
             (507, passages[0], "en", 1), (507, passages[0], "en", 1)]
    rnd.shuffle(rows)
    return rows


def brute_bytes(rows, length):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("length", [20, 45])
@pytest.mark.parametrize("shard_bytes", [300, 1 << 22])
def test_suffix_dedup_is_exact(spark, length, shard_bytes):
    rows = corpus()
    got = suffixes.drop_repeats(spark.createDataFrame(rows, DOCS), length=length, shard_bytes=shard_bytes).collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == brute_bytes(rows, length)


def brute_words(rows, window):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, 1 << 62), 1 << 62 if i is None else i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (1 << 62 if i is None else i):
                gone[p:p + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("shard_bytes", [300, 1 << 22])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_is_exact(spark, seed, shard_bytes):
    rows = corpus(seed)
    got = recompress.drop_repeats(spark.createDataFrame(rows, DOCS), shard_bytes=shard_bytes).collect()
    assert Counter(map(tuple, got)) == brute_words(rows, 13)


def test_symbols_end_within_four_words(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    for kinds in (2, 3, 50):
        names = rng.integers(0, 1 << 63, kinds, dtype=np.uint64)[rng.integers(0, kinds, 4000)]
        ends = np.flatnonzero(recompress.symbol_ends(names, np.array([0, 4000])) != recompress._NEVER)
        assert np.diff(ends).max() <= 4


def test_substring_window_must_hold_a_symbol_end(spark):
    with pytest.raises(ValueError):
        recompress.drop_repeats(spark.createDataFrame([], DOCS), window=8)


def shingles(text, k=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_groups(rows, percent):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[root(a)] = root(b)
    low = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            low[root(a)] = min(low.get(root(a), 1 << 62), i)
    return Counter((i, len(s), low.get(root(a)) if s else i) for a, (i, s) in enumerate(sets))


def near_corpus():
    rnd = random.Random(11)
    rows = []
    for g in range(8):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(30, 120))]
        for _ in range(12):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = f"n{rnd.randint(0, 10 ** 6)}"
            rows.append((len(rows) * 7 % 1000, " ".join(w).title() if rnd.random() < 0.3 else " ".join(w), "en", 0))
    rows += [(2000 + i, t, "en", 0) for i, t in enumerate([None, "", "  \n", "one two", "One  TWO", "one two three", "x " * 5000])]
    rows += [(3000 + i, "the same text of several words again", "en", 0) for i in range(40)] + [(None, rows[0][1], "en", 0)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups_match_all_pairs(spark, percent):
    rows = near_corpus()
    got = near.near_groups(spark.createDataFrame(rows, DOCS), percent).collect()
    assert Counter(map(tuple, got)) == brute_groups(rows, percent)


def test_near_copies_leave_one_of_each_group(spark):
    rows = near_corpus()
    docs = spark.createDataFrame(rows, DOCS)
    left = near.drop_near_copies(docs, 80)
    assert left.columns == docs.columns
    groups = brute_groups(rows, 80)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _, c in groups if i is None or i == c}


def test_groups_of_similar_but_mostly_unlinked_texts(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(110)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 2, 3])):
            w[rnd.randrange(110)] = f"n{rnd.randint(0, 10 ** 9)}"
        rows.append((rnd.randint(0, 10 ** 6) * 1000 + i, " ".join(w), "en", 0))
    shared = " ".join(base[:60])
    rows += [(i, f"{shared} {' '.join(f'u{i}x{k}' for k in range(rnd.randint(40, 90)))}", "en", 0) for i in range(80)]
    monkeypatch.setattr(near, "BLOCK", 16)
    got = near.near_groups(spark.createDataFrame(rows, DOCS), 85).collect()
    want = brute_groups(rows, 85)
    assert len({c for _, _, c in want}) > 50 and max(Counter(c for _, _, c in want).values()) > 10
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("texts", [["a b c d e f g", "a b"], ["", ""], ["x"], ["a b c d e f", "", None], ["a b c d", "q"], []])
def test_chunks_that_end_in_short_texts(texts):
    import numpy as np
    raw = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    sets, bounds = near.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert [int(n) for n in np.diff(bounds)] == [len(shingles(t)) for t in texts]


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["cid"]: r["label"] for r in near.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert suffixes.drop_repeats(none).count() == 0
    assert recompress.drop_repeats(none).count() == 0
    assert near.near_groups(none).count() == 0
    assert near.drop_near_copies(none).count() == 0


def vectors(n=300, dims=6, seed=2):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.0, rnd.random() - 0.5]) for _ in range(dims)]) for i in range(n)]
    rows[5] = (5, rows[40][1])
    return rows + [(1000, None), (1020, [0.1, None] + [0.0] * (dims - 2)), (1040, [float("nan")] * dims),
                   (1060, [float("inf")] * dims), (None, [0.1] * dims), (20, rows[20][1]), (1080, [0.0] * dims), (1100, [])]


@pytest.mark.parametrize("block_rows", [40, 4096])
def test_top_k_is_exact(spark, block_rows):
    import math
    rows = vectors()
    ok = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, v in ok:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok if c != q)[:20]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    ints = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")
                                .withColumn("embedding", F.col("embedding").cast("array<double>")))
    # floats widen exactly, so the fixture is rounded to floats first
    import struct
    ok2 = {(i, tuple(math.floor(64 * struct.unpack("f", struct.pack("f", x))[0]) for x in v)) for i, v in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, v in ok2:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok2 if c != q)[:20]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    got = topk.top_k(ints, ints.where("id % 20 = 0"), 20, block_rows).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_threshold_walk_stops_early():
    import numpy as np
    rng = np.random.default_rng(1)
    data = np.zeros((4000, 3))
    data[:, 0] = rng.integers(0, 1000, 4000)
    order = np.argsort(data, axis=0, kind="stable").T.copy()
    ids, scores, depth = topk.threshold_top(np.arange(4000), data, np.array([1.0, 0.0, 0.0]), -1, 20, order)
    assert depth < 400
    assert sorted(scores, reverse=True) == sorted(data[:, 0], reverse=True)[:20]


def test_top_k_of_nothing(spark):
    ints = topk.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(ints, ints).count() == 0


def test_queries_match_brute_force_on_a_table(spark):
    from letwise.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = Counter(map(tuple, queries.op4_suffix_dedup(spark, sf).collect()))
    assert got == Counter((i, n, g, s, sha(k)) for i, n, g, s, k in brute_bytes(rows, 400).elements())
    got = Counter(map(tuple, queries.op7_substring_dedup(spark, sf).collect()))
    assert got == Counter((i, n, g, sha(k.encode())) for i, n, g, k in brute_words(rows, 13).elements())
    got = Counter(map(tuple, queries.op6_minhash_dedup(spark, sf).collect()))
    assert got == Counter((i, n, c, i == c) for i, n, c in brute_groups(rows, 85).elements())
