"""The fact table as versioned Parquet snapshots.

Layout under a table root::

    <root>/v=00000001/part-*.parquet      data of version 1
    <root>/_commits/version=1/part-*.parquet   one-row commit record, written last

A version is visible only once its commit record exists, so a job that dies half-way
leaves an orphan folder that readers never see; the retry rewrites that folder. The
table is single-writer. Readers never read and overwrite the same path.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from letwise import schemas as S
from letwise.session import literal_frame


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def current_version(spark: SparkSession, root: str) -> int | None:
    """Latest committed version, or None when the table does not exist yet.

    Any other read failure (a corrupt commit log) is raised, never taken as "empty":
    treating a broken table as new would re-ingest everything (T25)."""
    try:
        log = spark.read.parquet(_commits(root))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    row = log.agg(F.max("version").alias("v")).first()
    return None if row is None or row["v"] is None else int(row["v"])


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table at ``version`` (default: latest), or None if there is none."""
    v = current_version(spark, root) if version is None else version
    if v is None:
        return None
    return spark.read.parquet(f"{root.rstrip('/')}/v={v:08d}")


def consumed_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Files (``file``, ``modified``) that committed versions were loaded from; None before the first."""
    try:
        log = spark.read.parquet(f"{root.rstrip('/')}/_consumed")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    done = spark.read.parquet(_commits(root)).select("version").distinct()
    return log.join(done, "version", "left_semi").select("file", "modified")


def commit_state(spark: SparkSession, root: str, writer_id: str, batch_id: int) -> tuple[int | None, bool]:
    """``(latest version, whether micro-batch batch_id of writer_id is already
    committed)`` from one read of the commit log. A replayed batch must not be applied
    twice."""
    if current_version(spark, root) is None:
        return None, False
    log = spark.read.parquet(_commits(root))
    hit = (F.col("writer_id") == writer_id) & (F.col("batch_id") == batch_id)
    row = log.agg(F.max("version").alias("v"), F.max(F.when(hit, 1)).alias("hit")).first()
    return int(row["v"]), row["hit"] is not None


def write_snapshot(df: DataFrame, root: str, partition_by: tuple[str, ...] = (),
                   sort_by: tuple[str, ...] = (S.KEY,), writer_id: str = "",
                   batch_id: int = -1, base_version: int | None = -1, consumed: DataFrame | None = None) -> int:
    """Write ``df`` as the next version and commit it. Returns the new version.

    Rows are sorted by key within each task, which compresses better; it prunes key lookups only where the
    rows are partitioned by key. ``consumed`` are the files the version was loaded from, which count as loaded
    once it is committed. ``writer_id``/``batch_id`` are recorded in the commit so a
    streaming writer can skip a replayed micro-batch. ``base_version`` is the version
    the new one is derived from, when the caller already knows it."""
    spark = df.sparkSession
    cur = current_version(spark, root) if base_version == -1 else base_version
    v = 1 if cur is None else cur + 1
    w = df.sortWithinPartitions(*sort_by) if sort_by else df
    # an existing folder for this version is an orphan of a failed attempt (never
    # committed, never read), so it is replaced
    writer = w.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/v={v:08d}")
    if consumed is not None:
        consumed.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/_consumed/version={v}")
    commit = literal_frame(spark,
        [(v, _dt.datetime.now(_dt.timezone.utc).isoformat(), writer_id, int(batch_id))],
        "version int, committed_at string, writer_id string, batch_id long")
    commit.write.mode("append").partitionBy("version").parquet(_commits(root))
    return v
