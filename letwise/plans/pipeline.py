"""Batch runs of the listing pipeline, expressed as one lazy plan per run.

``full_run``: landed pages (S1) -> flatten (P1) -> run date (P7) -> skip known ids (J1)
-> coordinates (J3) -> clean (W1, F1-F5, W2, J2) -> processed stage (S4) -> quarantine
blank keys -> upsert (M1) -> content dedup (M5) -> next table version (S7). ``load_raw`` starts from landed raw
CSV files (S3) instead of pages, ``load_processed`` from processed ones (S4). Run counters (A10) are observed on the same pass that
writes the snapshot, so counting costs no extra job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import functions as LF
from letwise import schemas as S
from letwise.operators.clean import clean_listings, drop_all_missing
from letwise.operators.dedup import content_dedup
from letwise.operators.flatten import item_to_row, stamp_run, to_raw
from letwise.operators.geo import lookup_coordinates
from letwise.operators.joins import skip_known
from letwise.operators.upsert import split_quarantine, upsert
from letwise.session import scratch_path
from letwise.sources.files import bad_pages, list_csv, page_items, read_page_log, read_raw_csv, split_corrupt
from letwise.sources.snapshot import consumed_files, current_version, read_snapshot, write_snapshot


@dataclass
class RunResult:
    version: int
    counters: dict = field(default_factory=dict)


def _count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a processed stage as Parquet under the shared checkpoint folder and read it
    back. This is the processed-file hand-off between clean and load: it cuts lineage
    (a lost executor never re-reads raw files) and keeps each plan short enough for
    the optimizer."""
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def quarantined(df: DataFrame, table_root: str, kind: str, run: str, quarantine_dir: str | None = None) -> int:
    """Write rows that cannot be loaded below the quarantine folder (``<table>/_quarantine`` by default, so they are
    never lost) and return how many. ``run`` names the run: a repeated run replaces its own rows."""
    root = quarantine_dir or f"{table_root.rstrip('/')}/_quarantine"
    kept, obs = _count(df, f"quarantined {kind}")
    kept.write.mode("overwrite").parquet(f"{root.rstrip('/')}/kind={kind}/run={run}")
    return obs.get["rows"]


def _next_run(spark: SparkSession, table_root: str) -> str:
    return f"v{(current_version(spark, table_root) or 0) + 1:08d}"


def merge_into_table(spark: SparkSession, cleaned: DataFrame, table_root: str,
                     quarantine_dir: str | None = None, staging_dir: str | None = None,
                     consumed: DataFrame | None = None) -> RunResult:
    """Stage the cleaned batch, quarantine blank keys, upsert into the latest version,
    drop content duplicates over the whole table, write the next version."""
    good, bad = split_quarantine(stage(spark, cleaned, "processed", staging_dir))
    blank = quarantined(bad, table_root, "blank_key", _next_run(spark, table_root), quarantine_dir)
    good, o_kept = _count(good, "kept")
    table = read_snapshot(spark, table_root)
    merged, o_merged = _count(upsert(table, good), "merged")
    final, o_final = _count(content_dedup(merged, K.CONTENT_DEDUP_COLUMNS), "final")
    version = write_snapshot(final, table_root, consumed=consumed)
    merged_rows = o_merged.get["rows"]
    counters = {"kept": o_kept.get["rows"], "blank_key": blank, "table_rows": o_final.get["rows"],
                "dedup_removed": merged_rows - o_final.get["rows"]}
    return RunResult(version, counters)


def full_run(spark: SparkSession, pages_dir: str, table_root: str, geo: DataFrame, mapping: DataFrame,
             run_date: str, skip_known_ids: bool = True, quarantine_dir: str | None = None) -> RunResult:
    """One scrape-to-table run over landed pages. Counters: pulled = skipped_known + new, new = excluded + kept +
    blank_key (+ rows with no field at all, which are dropped); bad_pages are quarantined."""
    log = read_page_log(spark, pages_dir)
    bad = quarantined(bad_pages(log), table_root, "bad_page", _next_run(spark, table_root), quarantine_dir)
    rows, o_in = _count(stamp_run(item_to_row(page_items(log)), run_date), "pulled")
    table = read_snapshot(spark, table_root)
    known = None if table is None else table.select(S.KEY)
    new, o_new = _count(skip_known(rows, known, enabled=skip_known_ids), "new")
    located = lookup_coordinates(new, "geo_query", geo)
    raw = drop_all_missing(to_raw(located)).select(*[LF.na_to_null(c).alias(c) for c in S.RAW_COLUMNS])
    res = merge_into_table(spark, clean_listings(raw, mapping, drop_empty_rows=False), table_root, quarantine_dir)
    res.counters.update({"pulled": o_in.get["rows"], "new": o_new.get["rows"], "bad_pages": bad})
    res.counters["skipped_known"] = res.counters["pulled"] - res.counters["new"]
    res.counters["excluded"] = res.counters["new"] - res.counters["kept"] - res.counters["blank_key"]
    return res


def _new_files(spark: SparkSession, folder: str, table_root: str) -> DataFrame:
    """CSV files of a folder that no committed version was loaded from. A file counts as new again when
    it was written anew."""
    files, done = list_csv(spark, folder), consumed_files(spark, table_root)
    files = files if done is None else files.join(done, ["file", "modified"], "left_anti")
    return stage(spark, files, "files")


def _load(spark: SparkSession, folder: str, table_root: str, quarantine_dir: str | None, clean) -> RunResult:
    files = _new_files(spark, folder, table_root)
    paths = [r["file"] for r in files.select("file").collect()]
    if not paths:
        return RunResult(current_version(spark, table_root) or 0, {"files": 0, "pulled": 0, "kept": 0})
    rows, o_in = _count(read_raw_csv(spark, paths), "pulled")
    good, corrupt = split_corrupt(stage(spark, rows, "raw"))
    bad = quarantined(corrupt, table_root, "corrupt", _next_run(spark, table_root), quarantine_dir)
    res = merge_into_table(spark, clean(good.drop("source_file")), table_root, quarantine_dir, consumed=files)
    pulled = o_in.get["rows"]
    res.counters.update({"files": len(paths), "pulled": pulled, "corrupt": bad,
                         "excluded": pulled - bad - res.counters["kept"] - res.counters["blank_key"]})
    return res


def load_raw(spark: SparkSession, raw_dir: str, table_root: str, mapping: DataFrame,
             quarantine_dir: str | None = None) -> RunResult:
    """Load the raw CSV files that no version was loaded from yet: scan (corrupt rows to quarantine), clean, merge.
    Counters: pulled = corrupt + blank_key + excluded + kept. Without new files nothing changes."""
    return _load(spark, raw_dir, table_root, quarantine_dir,
                 lambda good: clean_listings(good.drop("CPI"), mapping, drop_empty_rows=False))


def load_processed(spark: SparkSession, processed_dir: str, table_root: str,
                   quarantine_dir: str | None = None) -> RunResult:
    """Load processed CSV files (already cleaned, with ``CPI``) the same way, without cleaning them again."""
    return _load(spark, processed_dir, table_root, quarantine_dir, lambda good: good)
