"""S6 with outcomes (T15): the coordinate table as a log of lookups, of which only final ones count.

A lookup ends in a ``hit`` (both coordinates), a ``miss`` (the place is not known) or an ``error`` (the service failed).
Hits and misses are final and are not asked again; an error leaves its query open. The table is kept as an append-only
Parquet log, so a run writes only what it asked; ``current_lookups`` is the newest final state of every query, or its
newest error while it has none, and ``compact_lookups`` writes that state anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from letwise.operators.dedup import latest_per_key
from letwise.session import literal_frame

HIT, MISS, ERROR = "hit", "miss", "error"
LOOKUP = "query string, status string, lat double, lon double, looked_up_at timestamp"


def outcome(lat: Column, lon: Column, failed: Column) -> Column:
    """The status of a lookup: an error if it failed, else a hit only with both coordinates."""
    return (F.when(F.coalesce(failed, F.lit(False)), F.lit(ERROR))
            .when(lat.isNotNull() & lon.isNotNull(), F.lit(HIT)).otherwise(F.lit(MISS)))


def read_lookups(spark: SparkSession, path: str) -> DataFrame:
    """The log of lookups; empty where none was written yet."""
    try:
        return spark.read.schema(LOOKUP).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return literal_frame(spark, [], LOOKUP).where(F.lit(False))


def append_lookups(lookups: DataFrame, path: str) -> None:
    """Add lookups to the log. Queries that are null or blank are not lookups; coordinates of misses and errors are
    not kept. Writing the same lookups twice changes no state."""
    hit = F.col("status") == HIT
    rows = lookups.where(F.trim("query") != "").select(
        "query", "status", F.when(hit, F.col("lat")).alias("lat"), F.when(hit, F.col("lon")).alias("lon"), "looked_up_at")
    rows.write.mode("append").parquet(path)


def current_lookups(log: DataFrame) -> DataFrame:
    """One row a query: its newest final lookup, else its newest error. Of lookups of one time a hit goes before a
    miss, then the greatest pair. One aggregate with partial aggregation: a query asked a million times is one row a
    task."""
    ranked = log.where(F.col("query").isNotNull()).select(
        "query", (F.col("status") != ERROR).alias("_final"), "looked_up_at", (F.col("status") == HIT).alias("_hit"), "lat", "lon", "status")
    return latest_per_key(ranked, ["query"], ["_final", "looked_up_at", "_hit", "lat", "lon"]).select("query", "status", "lat", "lon", "looked_up_at")


def open_queries(wanted: DataFrame, log: DataFrame, query_col: str = "query") -> DataFrame:
    """The distinct queries that must be asked: not blank, and without a final lookup."""
    asked = wanted.select(F.col(query_col).alias("query")).where(F.trim("query") != "").distinct()
    final = log.where(F.col("status") != ERROR).select("query").distinct()
    return asked.join(final, "query", "left_anti")


def with_coordinates(rows: DataFrame, query_col: str, log: DataFrame) -> DataFrame:
    """``rows`` with ``latitude``, ``longitude`` and ``lookup_status`` (hit, miss, error; null if never asked).
    Rows stay one to one."""
    now = current_lookups(log).select(F.col("query").alias("_q"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("status").alias("_status"))
    kept = [c for c in rows.columns if c not in ("latitude", "longitude", "lookup_status")]
    j = rows.select(*kept).join(now, F.col(query_col) == F.col("_q"), "left")
    return j.select(*kept, F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"), F.col("_status").alias("lookup_status"))


def compact_lookups(spark: SparkSession, path: str, next_path: str) -> DataFrame:
    """Write the current state of a log as the start of the next one and return it."""
    current_lookups(read_lookups(spark, path)).write.parquet(next_path)
    return read_lookups(spark, next_path)
