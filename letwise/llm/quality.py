"""Quality classifier: supervised subword embeddings.

Hashed words and byte n-grams of a text each have a learned vector; a text is the average of its
vectors, followed by a softmax. The vectors are trained by stochastic gradient descent in numpy on
a bounded sample of labelled rows (``SAMPLE_ROWS``, ``SAMPLE_CHARS``). Since the output is linear in the average,
each bucket's vector is folded into one number for scoring, and only that table (``BUCKETS`` floats, a fixed size)
is broadcast; documents are scored in one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letwise.llm import textkit as tk

SAMPLE_ROWS = 4000
SAMPLE_CHARS = 24_000_000
BUCKETS = 1 << 18
DIMS = 8
EPOCHS = 6
RATE = 0.4
GRAMS = (3, 4)
THRESHOLD = 0.3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def features(data: np.ndarray, offsets: np.ndarray):
    """Buckets of a chunk's features: for each family, the buckets and the range of each document in them."""
    data = _LOWER[data]
    words = tk.Words(data, offsets)
    sums = tk.prefix(data)
    yield (tk.span_hash(sums, words.start, words.end) % np.uint64(BUCKETS)).astype(np.int64), words.first[:-1], words.first[1:]
    for n in GRAMS:
        at = np.arange(max(0, len(data) - n + 1))
        ids = (tk.mix(tk.span_hash(sums, at, at + n) + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64)
        lo = np.minimum(offsets[:-1], len(ids))
        yield ids, lo, np.maximum(lo, np.minimum(offsets[1:] - n + 1, len(ids)))


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and the share of its features in each."""
    raw = np.frombuffer(text.encode(), np.uint8)
    ids = np.concatenate([x[a[0]:b[0]] for x, a, b in features(raw, np.array([0, len(raw)]))])
    found, counts = np.unique(ids, return_counts=True)
    return found, (counts / max(1, len(ids))).astype(np.float32)


def train(rows: list[tuple[str, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """Score per bucket and bias, whose average and sum is the log odds of label 1.

    With no rows the odds are even; with rows of one label they are that label's smoothed share.
    """
    n, ones = len(rows), sum(y for _, y in rows)
    bias = float(np.log((ones + 1) / (n - ones + 1)))
    weights = np.zeros(BUCKETS, np.float32)
    if not n or ones in (0, n):
        return weights, bias
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    out = np.zeros((2, DIMS), np.float32)
    shift = np.array([0, bias], np.float32)
    docs = [(*counted(t), y) for t, y in rows]
    total = EPOCHS * n
    for step, i in enumerate(np.concatenate([rng.permutation(n) for _ in range(EPOCHS)])):
        ids, share, y = docs[i]
        rate = RATE * (1 - step / total)
        hidden = share @ vectors[ids] if len(ids) else np.zeros(DIMS, np.float32)
        z = out @ hidden + shift
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1
        back = p @ out
        out -= rate * np.outer(p, hidden)
        shift -= 0.1 * rate * p
        # one step for the whole document moves each vector by its share; a large share is a frequent feature
        vectors[ids] -= (rate * len(ids) ** 0.5) * np.outer(share, back)
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(shift[1] - shift[0])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts and about ``chars`` characters (whole texts, in the order of a hash of the id),
    of ids with crc32(id as text) mod 5 not 0. Null ids, labels other than 0 and 1, and missing texts are left out."""
    some = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
            .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
            .orderBy(F.xxhash64("__id"), "__id", "__y").limit(rows))
    size = F.sum(F.length("__t")).over(W.orderBy("__h", "__id", "__y", "__t").rowsBetween(W.unboundedPreceding, -1))
    found = (docs.select(F.col(id_col).alias("__d"), F.col(text_col).cast("string").alias("__t"))
             .join(F.broadcast(some), F.col("__d") == F.col("__id")).where("__t is not null")
             .select("__id", "__y", "__t", F.xxhash64("__id").alias("__h"))
             .orderBy("__h", "__id", "__y", "__t").limit(rows)
             .withColumn("__size", F.coalesce(size, F.lit(0))).where(F.col("__size") < chars))
    return [(r["__t"], r["__y"]) for r in found.orderBy("__h", "__id", "__y", "__t").collect()]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if at least ``threshold``).

    A null or empty text has the score of the bias alone. Columns already called so are replaced.
    """
    tk.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("score", "predicted")])
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])

    def scored(batches):
        weights, bias = shared.value
        for batch in tk.returning_memory(batches):
            data, offsets = tk.utf8(batch.column(text_col))
            out = np.empty(batch.num_rows)
            for i, j in tk.chunks(offsets):
                part = offsets[i:j + 1] - offsets[i]
                total, count = np.zeros(j - i), np.zeros(j - i)
                for ids, lo, hi in features(data[offsets[i]:offsets[j]], part):
                    sums = np.concatenate([[0.0], np.cumsum(weights[ids], dtype=np.float64)])
                    total += sums[hi] - sums[lo]
                    count += hi - lo
                out[i:j] = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "score"])

    return (plain.mapInArrow(scored, schema)
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the labelled sample of ``docs`` and score all of ``docs``."""
    model = train(labelled_sample(docs, labels, id_col, text_col))
    tk.return_memory()  # the sample and its features, which the driver held for the training
    return score_texts(docs, model, text_col)
