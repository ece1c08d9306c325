"""Hard-negative mining over lists shared by clusters of anchors.

Anchors are put into clusters by direction. For a cluster with centre c and widest member angle b, no member's inner
product with a candidate i can exceed ``|anchor| * |i| * cos(max(0, angle(i, c) - b))``. The candidates are sorted by
that bound once for the cluster, and every member walks the sorted list until the bound of what is left shows that
nothing unseen can enter its result. Candidates come in blocks of bounded size; each block answers for itself and
ranked windows, which Spark limits before their shuffle, merge the blocks.

The first walk finds each anchor's positives, the best rows of its own label; the second, for each positive, the
best rows of other labels whose score lies in a band below the positive's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from letwise.session import scratch_path, ship_package

BLOCK_ROWS = 8192
ANCHOR_ROWS = 16384
SAMPLE_ANCHORS = 4096
CLUSTER_MEMBERS = 16
ROUNDS = 8
FIRST_CHUNK = 256


def labelled_vectors(frame: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                     scale: int = 256) -> DataFrame:
    """``id``, ``label`` and ``v``: floor(scale * x) of each component x as double, as longs. Rows whose id, label or
    vector is null, or whose vector is empty or holds a null or non-finite component, take no part. Of rows that
    repeat an id, the one with the smallest label and vector stays."""
    label = F.col("label") if label is None else label
    rows = frame.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vec_col).cast("array<double>").alias("x"))
    rows = (rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0))
            .where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
            .select("id", "label", F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v")))
    return (rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("one"))
            .select("id", F.col("one.label").alias("label"), F.col("one.v").alias("v")))


def _unit(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((data * data).sum(axis=1))
    return data / np.maximum(norms, 1e-300)[:, None], norms


def centres(sample: np.ndarray, members: int = CLUSTER_MEMBERS, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of about one cluster for each ``members`` rows, by spherical k-means from evenly spaced rows."""
    unit, norms = _unit(sample)
    unit = unit[norms > 0]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    k = max(1, len(unit) // members)
    centre = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (unit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, unit)
        fresh, size = _unit(total)
        centre = np.where((size > 0)[:, None], fresh, centre)
    return centre


class Block:
    """Candidates of one block: ``ids``, ``labels``, ``data`` (whole numbers as doubles)."""

    def __init__(self, rows: pd.DataFrame):
        self.ids = rows["id"].to_numpy(np.int64)
        self.labels = rows["label"].to_numpy(np.int64)
        self.data = np.stack(rows["v"].to_numpy()).astype(np.float64)
        self.unit, self.norms = _unit(self.data)

    def shared_lists(self, members: np.ndarray, centre: np.ndarray) -> Iterator[tuple[np.ndarray, "Block", np.ndarray]]:
        """For each cluster of ``members`` (rows of vectors): its members, the block in the order of the cluster's
        bound, and the bounds for a member of length 1. The bounds are widened by more than the rounding of angles."""
        unit, norms = _unit(members)
        near = (unit @ centre.T).argmax(axis=1)
        for c in np.unique(near):
            own = np.flatnonzero(near == c)
            cosine = np.clip(unit[own[norms[own] > 0]] @ centre[c], -1, 1)
            widest = np.arccos(cosine.min()) if len(cosine) else np.pi
            apart = np.arccos(np.clip(self.unit @ centre[c], -1, 1)) - widest
            bound = self.norms * (np.cos(np.maximum(apart, 0)) + 1e-7)
            order = np.argsort(-bound, kind="stable")
            listed = object.__new__(Block)
            listed.ids, listed.labels, listed.data = self.ids[order], self.labels[order], self.data[order]
            yield own, listed, bound[order]


def walk(listed: Block, bound: np.ndarray, vector: np.ndarray, wanted: Callable, needed: Callable) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores that a member keeps of its cluster's list, and how much of the list it read.

    It reads chunks that double in size. ``wanted(ids, labels, scores)`` says which rows to keep of those kept and
    read so far; ``needed(scores)`` the least score that could still change the result. The walk ends once no
    unread row can reach it."""
    length = float(np.sqrt(vector @ vector))
    ids, labels, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    lo, n, step = 0, len(bound), FIRST_CHUNK
    while lo < n and not length * bound[lo] < needed(scores):
        hi = min(n, lo + step)
        ids = np.concatenate([ids, listed.ids[lo:hi]])
        labels = np.concatenate([labels, listed.labels[lo:hi]])
        scores = np.concatenate([scores, listed.data[lo:hi] @ vector])
        keep = wanted(ids, labels, scores)
        ids, labels, scores = ids[keep], labels[keep], scores[keep]
        lo, step = hi, step * 2
    return ids, scores, lo


def first(ids: np.ndarray, scores: np.ndarray, some: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``some``, those of the ``k`` highest scores, ties to the smaller id, in order."""
    if len(some) > 4 * k:
        some = some[scores[some] >= np.partition(scores[some], len(some) - k)[len(some) - k]]
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def positives_of(block: Block, asked: pd.DataFrame, centre: np.ndarray, k: int) -> list[pd.DataFrame]:
    """Each anchor's ``k`` best rows of its label in a block."""
    out = []
    own_ids, own_labels = asked["id"].to_numpy(np.int64), asked["label"].to_numpy(np.int64)
    vectors = np.stack(asked["v"].to_numpy()).astype(np.float64)
    for members, listed, bound in block.shared_lists(vectors, centre):
        for a in members:
            def wanted(ids, labels, scores, a=a):
                return first(ids, scores, np.flatnonzero((labels == own_labels[a]) & (ids != own_ids[a])), k)

            ids, scores, _ = walk(listed, bound, vectors[a], wanted, lambda s: s[-1] if len(s) == k else -np.inf)
            out.append(pd.DataFrame({"anchor_id": own_ids[a], "positive_id": ids, "positive_score": scores.astype(np.int64)}))
    return out


def negatives_of(block: Block, asked: pd.DataFrame, centre: np.ndarray, k: int, low: int, high: int) -> list[pd.DataFrame]:
    """For each anchor and each of its ``positives`` (structs of score and id), the ``k`` best rows of other labels in
    a block with ``low * positive <= 100 * negative <= high * positive``."""
    out = []
    own_ids, own_labels = asked["id"].to_numpy(np.int64), asked["label"].to_numpy(np.int64)
    vectors = np.stack(asked["v"].to_numpy()).astype(np.float64)
    told = [[(int(p["positive_id"]), int(p["positive_score"])) for p in ps] for ps in asked["positives"]]
    for members, listed, bound in block.shared_lists(vectors, centre):
        for a in members:
            # least and greatest whole score of each positive's band; an empty band asks for nothing
            bands = [(-(-low * s // 100), high * s // 100) for _, s in told[a]]

            def of_band(ids, scores, lo, hi):
                return first(ids, scores, np.flatnonzero((scores >= lo) & (scores <= hi)), k)

            def wanted(ids, labels, scores, a=a, bands=bands):
                other = np.flatnonzero(labels != own_labels[a])
                kept = [other[of_band(ids[other], scores[other], lo, hi)] for lo, hi in bands]
                return np.unique(np.concatenate(kept)) if kept else other[:0]

            def needed(scores, bands=bands):
                least = np.inf
                for lo, hi in bands:
                    if lo <= hi:
                        inside = scores[(scores >= lo) & (scores <= hi)]
                        least = min(least, np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else lo)
                return least

            ids, scores, _ = walk(listed, bound, vectors[a], wanted, needed)
            for (positive, score), (lo, hi) in zip(told[a], bands):
                best = of_band(ids, scores, lo, hi)
                out.append(pd.DataFrame({"anchor_id": own_ids[a], "positive_id": positive, "positive_score": score,
                                         "negative_id": ids[best], "negative_score": scores[best].astype(np.int64)}))
    return out


def _sampled_centres(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Centres for each number of dimensions, from at most ``SAMPLE_ANCHORS`` anchors in the order of a hash."""
    some = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ANCHORS).select("v").collect()
    by: dict[int, list] = {}
    for r in some:
        by.setdefault(len(r["v"]), []).append(r["v"])
    return {d: centres(np.array(rows, np.float64)) for d, rows in by.items()}


def mine(candidates: DataFrame, anchors: DataFrame, k_positives: int = 5, k_negatives: int = 5, low: int = 80,
         high: int = 100, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both inputs have ``id`` (unique), ``label`` and ``v``. An anchor's positives are the ``k_positives`` rows of its
    label and another id with the highest inner products. For each of them, the ``k_negatives`` best rows of other
    labels within the band are returned, all if fewer; ties go to the smaller id. Vectors are compared only with
    vectors of as many dimensions. Empty inputs give an empty result. Scores must stay below 2**53.

    The cluster centres are fitted on a bounded sample of anchors; they only decide how early walks end. A task
    holds one block of candidates and one of anchors: candidates are sent once for each ``anchor_rows`` anchors."""
    spark = candidates.sparkSession
    ship_package(spark)
    centre = _sampled_centres(anchors)
    n_blocks = max(1, -(-candidates.count() // block_rows))
    a_blocks = max(1, -(-anchors.count() // anchor_rows))

    def dealt(frame: DataFrame, names: tuple[str, str], mine_: int, other: int) -> DataFrame:
        own = [F.col(c).alias(c) for c in frame.columns]  # new columns: both sides may come from one frame
        return frame.select(*own, F.pmod(F.xxhash64("id"), F.lit(mine_)).cast("int").alias(names[0]), F.size("v").alias("dims"),
                            F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]))

    def answered(asked: DataFrame, search: Callable, schema: str) -> DataFrame:
        def block(rows: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
            names = [c.split()[0] for c in schema.split(", ")]
            none = pd.DataFrame({c: np.zeros(0, np.int64) for c in names})
            if not len(rows) or not len(members):
                return none
            dims = len(rows["v"].iloc[0])
            found = search(Block(rows), members, centre.get(dims, np.zeros((1, dims))))
            return pd.concat(found)[names] if found else none

        left = dealt(candidates, ("b", "a"), n_blocks, a_blocks).groupBy("b", "a", "dims")
        right = dealt(asked, ("a", "b"), a_blocks, n_blocks).groupBy("b", "a", "dims")
        return left.cogroup(right).applyInPandas(block, schema)

    found = answered(anchors.select("id", "label", "v"), lambda b, m, c: positives_of(b, m, c, k_positives),
                     "anchor_id long, positive_id long, positive_score long")
    best = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    path = scratch_path(spark, "positives")
    found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k_positives).drop("place").write.parquet(path)
    told = (spark.read.parquet(path).groupBy("anchor_id")
            .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")))
    asked = anchors.select("id", "label", "v").join(told, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    found = answered(asked, lambda b, m, c: negatives_of(b, m, c, k_negatives, low, high),
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k_negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(c.x) = len(a.x)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
r AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS n
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE n <= 5
"""
