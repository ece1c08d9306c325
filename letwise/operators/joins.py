"""Join helpers. No join carries a broadcast hint: Spark broadcasts a side whose size it knows to be small, at
planning or, through AQE, from what a shuffle has measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skip_known(incoming: DataFrame, known_ids: DataFrame | None, key: str = "ads_id",
               enabled: bool = True) -> DataFrame:
    """Keep incoming rows whose key is not in the known id set (left anti join).

    No known set (missing table) keeps everything. Never ``NOT IN``: its null-aware
    anti join can only run as a broadcast of the whole id set. The known side is made
    distinct first (partial aggregation, same ``_known_id`` partitioning the join needs),
    so a repeated id cannot pile up in one join task."""
    if not enabled or known_ids is None:
        return incoming
    known = (known_ids.select(F.col(key).cast("string").alias("_known_id"))
             .where(F.col("_known_id").isNotNull()).distinct())
    return incoming.join(known, incoming[key].cast("string") == known["_known_id"], "left_anti")
