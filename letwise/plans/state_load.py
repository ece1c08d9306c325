"""Loads into the state-partitioned table (S7), with upsert (M1) and content rule (M5) kept to what a batch touches.

What one load of a batch reads and writes:

* the ids of the table (one column) to see in which folders the batch's listings are stored now;
* the folders of these states and of the batch's states, all others are neither read nor written;
* in those folders, rows whose id the batch does not hold and whose content hash no merged row has pass straight to
  the writer: no shuffle, only semi joins against the ids and hashes of the batch, which are broadcast up to
  ``BROADCAST_ROWS`` rows and shuffled beyond;
* the rest, a few rows for each row of the batch, goes through the upsert and the content rule.

Since the table obeys the content rule before a load, only groups that hold a merged row can break it, and each of
them has at most one stored row. The result equals the full rule over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import schemas as S
from letwise.operators.availability import recheck_by_day
from letwise.operators.dedup import content_dedup, latest_per_key
from letwise.operators.upsert import merge_prepared, prepare_batch
from letwise.session import scratch_path
from letwise.sources.states import HASH, PART, empty_part, overwrite_parts, part_of, read_stored, to_stored


BROADCAST_ROWS = 200_000


def beside(keys: DataFrame, rows: int) -> DataFrame:
    """Keys to join with the table: broadcast if they are few, else both sides are shuffled. The count decides, for Spark
    takes a column's size from the compressed file, and millions of ids would be collected on the driver."""
    return F.broadcast(keys) if rows <= BROADCAST_ROWS else keys.hint("merge")


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _names(df: DataFrame) -> list[str]:
    """Folder names in a frame: as many as states, which Spark lists on the driver anyway."""
    return sorted(r[0] for r in df.select(PART).distinct().collect())


def untouched(stored: DataFrame, ids: DataFrame, hashes: DataFrame) -> DataFrame:
    """Stored rows whose id is not in ``ids`` and whose content hash is not in ``hashes``. Null hashes do not occur."""
    return stored.join(ids, S.KEY, "left_anti").join(hashes, HASH, "left_anti")


def merge_states(spark: SparkSession, batch: DataFrame, root: str,
                 order_cols: Sequence[str] = ("scrape_date", "load_key"), guard_late: bool = True) -> dict:
    """Load a batch (blank keys split off before) into the table at ``root``. Counters: ``batch_keys``, ``parts`` (the
    folders rewritten), ``emptied``, ``regrouped`` (rows that went through the content rule), ``dedup_removed``."""
    prepared = _staged(spark, prepare_batch(batch, order_cols).where(F.col(S.KEY).isNotNull()), "batch")
    n_keys = prepared.count()
    ids = beside(prepared.select(S.KEY), n_keys)
    stored = read_stored(spark, root)
    held = stored.select(S.KEY, PART).join(ids, S.KEY, "left_semi")
    before, into = _names(held), _names(prepared.select(part_of("state").alias(PART)))
    parts = sorted({*before, *into})
    if not parts:
        return {"batch_keys": 0, "parts": [], "emptied": [], "regrouped": 0, "dedup_removed": 0}

    touched = read_stored(spark, root, parts)
    # one row a key: a load that died while folders were moved can leave a listing in its old and its new state
    mine = latest_per_key(touched.join(ids, S.KEY, "left_semi").select(*S.TABLE_COLUMNS), [S.KEY], ["scrape_date", "load_key"])
    merged = _staged(spark, to_stored(merge_prepared(mine, prepared, order_cols, guard_late)), "merged")
    hashes = beside(merged.select(HASH).distinct(), merged.count())
    rivals = touched.join(ids, S.KEY, "left_anti").join(hashes, HASH, "left_semi")
    group = _staged(spark, merged.unionByName(rivals), "groups")
    kept = _staged(spark, content_dedup(group, K.CONTENT_DEDUP_COLUMNS), "kept")
    calm = untouched(touched, ids, hashes)
    # a folder that a listing left may have no row any more
    left = [p for p in before if p not in _names(kept)] if before else []
    emptied = [p for p in left if untouched(read_stored(spark, root, [p]).select(S.KEY, HASH), ids, hashes).isEmpty()]
    overwrite_parts(calm.unionByName(kept.hint("rebalance", PART)), root)
    for p in emptied:
        empty_part(spark, root, p)
    grouped, remained = group.count(), kept.count()
    return {"batch_keys": n_keys, "parts": [p for p in parts if p not in emptied], "emptied": emptied,
            "regrouped": grouped, "dedup_removed": grouped - remained}


def recheck_states(spark: SparkSession, probe_log: DataFrame, root: str) -> dict:
    """M3 over the state-partitioned table: probes, each on its own day (``recheck_by_day``), rewrite only the folders
    of the listings they are about. Applying the same probes twice changes nothing."""
    probes = _staged(spark, probe_log.where(F.col("ads_id").isNotNull()), "probes")
    ids = beside(probes.select(S.KEY).distinct(), probes.count())
    parts = _names(read_stored(spark, root).select(S.KEY, PART).join(ids, S.KEY, "left_semi"))
    if not parts:
        return {"parts": [], "probed": 0}
    touched = read_stored(spark, root, parts)
    probed = _staged(spark, recheck_by_day(touched.join(ids, S.KEY, "left_semi"), probes), "probed")
    overwrite_parts(touched.join(ids, S.KEY, "left_anti").unionByName(probed.hint("rebalance", PART)), root)
    return {"parts": parts, "probed": probed.count()}
