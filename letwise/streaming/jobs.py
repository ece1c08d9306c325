"""Structured Streaming forms of the repeated incremental runs.

* ST1 ``ingest_raw``: new raw CSV files are cleaned and added exactly once (native text file
  source + checkpoint + one output folder per micro-batch; ``availableNow`` processes
  what is there and stops). ``load_stream`` merges them into the table by state instead. Both can archive
  the files they loaded (S12) and count what every micro-batch did (A10).
* ST2 ``upsert_stream``: each micro-batch is merged into the versioned table through
  ``foreachBatch``; a replayed batch id is skipped, so the sink is idempotent.
* ST3 ``dedup_sightings``: repeated sightings of a listing across slices within a
  watermark are dropped.
* ST4 ``recheck_stream``: probe results arriving over time drive the availability
  transition, one table version per micro-batch. ``recheck_states_stream`` does so on the table by state, of
  which a micro-batch rewrites only the states that its probes are about, and counts what came (A10).

Every job takes an explicit checkpoint location; callers pass a folder under the
cluster's shared checkpoint directory (``letwise.session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letwise import schemas as S
from letwise.operators.availability import probe_counters, recheck_by_day
from letwise.operators.clean import clean_listings
from letwise.operators.upsert import split_quarantine, upsert
from letwise.plans.pipeline import stage
from letwise.plans.state_load import merge_states, recheck_states
from letwise.session import literal_frame
from letwise.sources.files import split_corrupt
from letwise.sources.records import named_rows, record_stream, staged_records
from letwise.sources.snapshot import commit_state, read_snapshot, write_snapshot
from letwise.sources.states import read_stored


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint. Micro-batch numbers start anew with a new checkpoint,
    so sinks name their batches by both."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _place(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    return f"query={stream_id(spark, checkpoint)}/batch_id={batch_id}"


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _landed(batch: DataFrame, mapping: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """A micro-batch of landed lines, staged once: its listing rows, the cleaned ones, the corrupt ones, and how many
    records came."""
    records = staged_records(batch)
    rows = stage(batch.sparkSession, named_rows(records), "rows")
    good, corrupt = split_corrupt(rows)
    return rows, clean_listings(good.drop("source_file", "CPI"), mapping, drop_empty_rows=False), corrupt, records.count()


def _run(stream: DataFrame, apply, checkpoint: str) -> StreamingQuery:
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


LOADS, RECHECKS = "_counters", "_recheck_counters"


def _write_counters(spark: SparkSession, root: str, place: str, counters: dict[str, int], kind: str = LOADS) -> None:
    """A10: one row of counters a micro-batch, in a folder of its own, so that a replay replaces it."""
    names = sorted(counters)
    literal_frame(spark, [tuple(int(counters[c]) for c in names)], ", ".join(f"{c} long" for c in names)) \
        .write.mode("overwrite").parquet(f"{root}/{kind}/{place}")


def read_counters(spark: SparkSession, root: str, kind: str = LOADS) -> DataFrame:
    """A10: the counters of every micro-batch of loads or of re-checks: ``query``, ``batch_id`` and one column a
    counter."""
    return spark.read.parquet(f"{root.rstrip('/')}/{kind}")


def ingest_raw(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
               mapping: DataFrame | None = None, max_files_per_trigger: int | None = None,
               quarantine_dir: str | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """ST1: clean every new raw file once and add it to ``sink_dir`` (Parquet). Rows that do not parse go to
    ``quarantine_dir`` (``<sink>/_quarantine`` by default); with ``archive_dir`` loaded files move there (S12).

    The lines come through the file source itself and are staged once a micro-batch; only files with line breaks in
    fields are read again, as a whole. The cleaning runs as batch code on the staged records and writes the batch to its own
    folder ``query=<id>/batch_id=<n>`` with overwrite, so a replayed micro-batch rewrites the same folder and another
    checkpoint never meets it: the sink is exactly-once. Counters (A10): pulled = corrupt + excluded + kept."""
    root = sink_dir.rstrip("/")
    bad_root = (quarantine_dir or f"{root}/_quarantine").rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        place = _place(spark, checkpoint, batch_id)
        rows, cleaned, corrupt, records = _landed(batch, mapping)
        corrupt, bad = _counted(corrupt, "corrupt")
        corrupt.write.mode("overwrite").parquet(f"{bad_root}/{place}")
        cleaned, kept = _counted(cleaned, "kept")
        cleaned.write.mode("overwrite").parquet(f"{root}/{place}")
        pulled = rows.count()
        _write_counters(spark, root, place, {
            "records": records, "pulled": pulled, "corrupt": bad.get["rows"], "kept": kept.get["rows"],
            "excluded": pulled - bad.get["rows"] - kept.get["rows"]})

    return _run(record_stream(spark, source_dir, max_files_per_trigger, archive_dir), apply, checkpoint)


def load_stream(spark: SparkSession, source_dir: str, table_root: str, checkpoint: str, mapping: DataFrame | None = None,
                max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """ST1 + ST2 + S12: new raw files are cleaned and merged into the table by state, which rewrites only the states
    that a micro-batch touches (``merge_states``); a replayed micro-batch changes nothing. Loaded files move to
    ``archive_dir``; those of a batch that fails stay. Corrupt rows and blank keys go to ``<table>/_quarantine``.
    Counters: pulled = corrupt + excluded + blank_key + kept, and the folders rewritten."""
    root = table_root.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        place = _place(spark, checkpoint, batch_id)
        rows, cleaned, corrupt, records = _landed(batch, mapping)
        good, blank = split_quarantine(cleaned)
        corrupt, bad = _counted(corrupt, "corrupt")
        corrupt.write.mode("overwrite").parquet(f"{root}/_quarantine/kind=corrupt/{place}")
        blank, keyless = _counted(blank, "blank")
        blank.write.mode("overwrite").parquet(f"{root}/_quarantine/kind=blank_key/{place}")
        good, kept = _counted(good, "kept")
        done = merge_states(spark, good, root)
        pulled = rows.count()
        _write_counters(spark, root, place, {
            "records": records, "pulled": pulled, "corrupt": bad.get["rows"], "blank_key": keyless.get["rows"],
            "kept": kept.get["rows"], "excluded": pulled - bad.get["rows"] - keyless.get["rows"] - kept.get["rows"],
            "keys": done["batch_keys"], "parts": len(done["parts"]), "dedup_removed": done["dedup_removed"]})

    return _run(record_stream(spark, source_dir, max_files_per_trigger, archive_dir), apply, checkpoint)


def upsert_stream(source: DataFrame, table_root: str, checkpoint: str, writer_id: str,
                  order_cols: Sequence[str] = ("scrape_date", "load_key"),
                  quarantine_dir: str | None = None) -> StreamingQuery:
    """ST2: merge each micro-batch into the versioned table (read latest snapshot ->
    upsert -> write next version). Blank keys go to ``quarantine_dir`` (``<table>/_quarantine`` by default), each
    batch to a folder of its own. A batch already committed by ``writer_id`` under this checkpoint is skipped, so
    replays after a failure are harmless. Each batch reads the table back from storage, so lineage never grows."""
    bad_root = (quarantine_dir or f"{table_root.rstrip('/')}/_quarantine").rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = stream_id(spark, checkpoint)
        writer = f"{writer_id}/{query}"
        version, done = commit_state(spark, table_root, writer, batch_id)
        if done:
            return
        good, bad = split_quarantine(batch)
        bad.write.mode("overwrite").parquet(f"{bad_root}/query={query}/batch_id={batch_id}")
        table = None if version is None else read_snapshot(spark, table_root, version)
        write_snapshot(upsert(table, good, order_cols), table_root, writer_id=writer,
                       batch_id=batch_id, base_version=version)

    q = (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def dedup_sightings(stream: DataFrame, key: str = S.KEY, event_time: str = "seen_at",
                    delay: str = "1 day") -> DataFrame:
    """ST3: keep the first sighting of each listing within the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def recheck_stream(probes: DataFrame, table_root: str, checkpoint: str, writer_id: str) -> StreamingQuery:
    """ST4: each micro-batch of probe results (``ads_id, checked_at, http_ok, n_items``)
    is applied to the latest table version, every probe on its own day and in time order (``recheck_by_day``), so
    the result does not depend on how the log is cut into micro-batches. Without a table the query fails
    before its offsets are recorded, and the probes wait in the source."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = f"{writer_id}/{stream_id(spark, checkpoint)}"
        version, done = commit_state(spark, table_root, writer, batch_id)
        if done:
            return
        if version is None:
            raise ValueError(f"no table at {table_root} yet; its probes stay in the source")
        table = read_snapshot(spark, table_root, version)
        write_snapshot(recheck_by_day(table, batch), table_root,
                       writer_id=writer, batch_id=batch_id, base_version=version)

    q = (probes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def recheck_states_stream(probes: DataFrame, table_root: str, checkpoint: str) -> StreamingQuery:
    """ST4 on the table by state: a micro-batch of probe results rewrites only the folders of the listings it is about
    (``recheck_states``); probes of listings that the table does not hold change nothing. Replaying a micro-batch changes
    nothing, for a probe that was applied finds its listing gone or not due. While the table holds no listing the
    query fails and the probes wait in the source. Counters (A10): pulled = alive + gone + failed, ``probed`` listings
    of the table (each once) and the folders rewritten."""
    root = table_root.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if read_stored(spark, root).isEmpty():
            raise ValueError(f"no table at {root} yet; its probes stay in the source")
        log = stage(spark, batch, "probes")
        done = recheck_states(spark, log, root)
        sums = [F.coalesce(F.sum(f"n_{x}"), F.lit(0)).alias(x) for x in ("alive", "gone", "failed")]
        seen = probe_counters(log).agg(*sums).first().asDict()
        _write_counters(spark, root, _place(spark, checkpoint, batch_id),
                        {"pulled": log.count(), "probed": done["probed"], "parts": len(done["parts"]), **seen}, RECHECKS)

    return _run(probes, apply, checkpoint)
