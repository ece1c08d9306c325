"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Rows are dealt into blocks of bounded size. In each block every dimension has its list of rows
sorted by value. A query walks all lists from its better end; the sum over dimensions of query
value times the value reached bounds every row not met yet, and the walk stops once that bound is
below the k-th score so far. Each block returns k rows a query, and a ranked window (which Spark
limits before its shuffle) merges the blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
FIRST_DEPTH = 8
RETRY = 16


def integer_vectors(frame: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of each component x as double, as longs. Rows whose id or vector is
    null, or whose vector is empty or holds a null or non-finite component, take no part. Rows that
    repeat an id with an equal vector count once."""
    v = F.col(vec_col).cast("array<double>")
    return (frame.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .where(F.size("v") > 0)
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
            .select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"))
            .distinct())


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id, in order."""
    if len(scores) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def threshold_top(ids: np.ndarray, data: np.ndarray, query: np.ndarray, own: int, k: int, order: np.ndarray,
                  depth: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids, scores and the depth reached of the ``k`` best rows of one block for one query.

    ``order``: for each dimension the rows sorted by value, ascending. The walk looks at ``depth`` rows of each
    list, then twice as many, until no unseen row can reach the k-th score (ties go to the smaller id, so a bound
    equal to it does not stop the walk) or the lists have shown every row. A query of zeros has no list to walk: all
    rows tie. The scores of the rows met are one product, over the whole block where that is the cheaper one.
    """
    n, _ = data.shape
    used = np.flatnonzero(query)
    up = query[used] > 0
    seen = np.zeros(n, bool)
    rows, scores, lo, hi = np.zeros(0, np.int64), np.zeros(0, data.dtype), 0, min(depth, n)
    while True:
        before = seen.copy()
        if len(used):
            seen[np.where(up[:, None], order[used, n - hi:n - lo], order[used, lo:hi])] = True
        else:
            seen[:] = True
        new = np.flatnonzero(seen & ~before & (ids != own))
        fresh = data[new] @ query if 8 * len(new) < n else (data @ query)[new]
        rows, scores = np.concatenate([rows, new]), np.concatenate([scores, fresh])
        top = best_of(ids[rows], scores, k)
        rows, scores = rows[top], scores[top]
        if seen.all():
            break
        last = np.where(up, order[used, n - hi], order[used, hi - 1])
        if len(rows) == k and data[last, used] @ query[used] < scores[-1]:
            break
        lo, hi = hi, min(2 * hi, n)
    return ids[rows], scores, hi


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products of every query (columns ``id`` and
    ``v`` on both sides) with all candidates of another id; all of them if fewer. Ties go to the smaller vec_id.

    Vectors are compared only with vectors of as many dimensions. Rows that repeat an id with another vector are
    candidates of their own, and the answers of queries that share an id are ranked together. Empty inputs
    give an empty result. Scores must stay below 2**53.
    """
    n = candidates.count()
    m = queries.count()
    n_blocks, q_blocks = max(1, -(-n // block_rows)), max(1, -(-m // block_rows))

    def dealt(frame: DataFrame, mine: int, other: int, names: tuple[str, str]) -> DataFrame:
        return frame.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(mine)).cast("int").alias(names[0]),
                            F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]),
                            F.size("v").alias("dims"))

    left = dealt(candidates, n_blocks, q_blocks, ("b", "q")).groupBy("b", "q", "dims")
    right = dealt(queries, q_blocks, n_blocks, ("q", "b")).groupBy("b", "q", "dims")

    def block(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            ids = rows["id"].to_numpy(np.int64)
            data = np.stack(rows["v"].to_numpy()).astype(np.float64)
            order = np.argsort(data, axis=0, kind="stable").T.copy()
            depth = FIRST_DEPTH
            for turn, (own, v) in enumerate(zip(asked["id"].to_numpy(np.int64), asked["v"])):
                # begin as deep as the last walk had to go, and try a short one now and then
                first = FIRST_DEPTH if turn % RETRY == 0 else depth
                found, scores, depth = threshold_top(ids, data, np.asarray(v, np.float64), own, k, order, first)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    found = left.cogroup(right).applyInPandas(block, "query_id long, vec_id long, score long")
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
