"""Key dedup (D1/R2) and content dedup.

Both aggregate a struct instead of ranking in a window: a ``max``/``min`` of a struct keeps one
whole row per group and is computed partially before the shuffle, so a hot key that holds a
third of all rows costs one row per map task. A struct buffer has no fixed width, so Spark plans
these as sort aggregates: each task sorts its own rows by key first. Ties are broken by the remaining columns, so the
chosen row never depends on input order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                 latest: bool = True, also: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the row with the greatest (``latest``) or smallest ``order_cols``
    tuple; the rest of the row breaks ties. Column order of ``df`` is kept; the aggregates ``also``
    over the key's rows follow."""
    keys = list(keys)
    order_cols = [c for c in order_cols]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)] + \
             [F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)]
    agg = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"), *also)
    extra = [c for c in picked.columns if c not in keys and c != "_pick"]
    out = {k: F.col(k) for k in keys}
    out.update({c: F.col(f"_pick._o{i}").alias(c) for i, c in enumerate(order_cols)})
    out.update({c: F.col(f"_pick._r{i}").alias(c) for i, c in enumerate(rest)})
    return picked.select(*[out[c].alias(c) for c in df.columns], *extra)


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The first row per key in an explicit order (smallest ``order_cols``)."""
    return pick_per_key(df, keys, order_cols, latest=False)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """R2: the latest row per key (greatest ``order_cols``, e.g. scrape date, file, position)."""
    return pick_per_key(df, keys, order_cols, latest=True)


def content_dedup(df: DataFrame, content_cols: Sequence[str], key: str = "ads_id") -> DataFrame:
    """Among rows equal on ``content_cols`` (NULL equals NULL) keep the one with the
    smallest key, compared as text (``'100' < '99'``). One shuffle on the content columns,
    with partial aggregation; no join back."""
    content_cols = list(content_cols)
    rest = [c for c in df.columns if c not in content_cols and c != key]
    fields = [F.col(key).cast("string").alias("_k"), F.col(key).alias("_key")] + \
             [F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)]
    kept = df.groupBy(*content_cols).agg(F.min(F.struct(*fields)).alias("_pick"))
    out = {c: F.col(c) for c in content_cols}
    out[key] = F.col("_pick._key")
    out.update({c: F.col(f"_pick._r{i}") for i, c in enumerate(rest)})
    return kept.select(*[out[c].alias(c) for c in df.columns])
