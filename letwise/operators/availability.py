"""Availability tracking: due selection, probe outcomes, the re-check transition and
the snapshot diff.

State machine: ``active -> rented | expired`` here; ``rented | expired -> active`` only
through the upsert. All steps are set-based: the due flag is a column of the table, the
probe outcomes are joined once on ``ads_id`` and every row is rewritten by ``when`` rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letwise import constants as K
from letwise import functions as LF
from letwise.operators.dedup import latest_per_key

ALIVE, GONE, UNKNOWN = "alive", "gone", "unknown"


def non_terminal(status_col: str = "availability_status") -> Column:
    """Status NULL or not in (rented, expired)."""
    s = F.col(status_col)
    return s.isNull() | ~s.isin(*K.TERMINAL_STATUSES)


def with_due_flag(table: DataFrame, today, out: str = "_due") -> DataFrame:
    """W3 + W4 as one boolean column on the table."""
    due = LF.due_for_check("first_seen", "last_checked_at", today)
    return table.withColumn(out, non_terminal() & due)


def due_listings(table: DataFrame, today, limit: int | None = None,
                 columns: Sequence[str] = ("ads_id", "first_seen", "last_checked_at", "ad_expiry")) -> DataFrame:
    """W3 + W4 (+ L1): the non-terminal listings due for a check. With ``limit`` (> 0) only
    the ``limit`` least recently checked (never checked first, then by id); the order is
    total, so the cap is deterministic. ``0``/``None`` means no cap."""
    due = with_due_flag(table, today).where("_due").select(*columns)
    if limit:
        last = LF.parse_day("last_checked_at")
        due = due.orderBy(last.asc_nulls_first(), F.col("ads_id").asc()).limit(int(limit))
    return due


def probe_outcomes(probe_log: DataFrame) -> DataFrame:
    """The latest probe per listing -> outcome ``alive`` (items returned), ``gone``
    (empty result) or ``unknown`` (the lookup failed, T19)."""
    latest = latest_per_key(probe_log.select("ads_id", "checked_at", "http_ok", "n_items"),
                            ["ads_id"], ["checked_at"])
    outcome = (F.when(F.col("http_ok").isNull() | ~F.col("http_ok"), F.lit(UNKNOWN))
               .when(F.col("n_items") > 0, F.lit(ALIVE))
               .otherwise(F.lit(GONE)))
    return latest.select("ads_id", outcome.alias("outcome"))


def split_open(table: DataFrame, changes: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that a re-check may change, and all others. The latter need no join: they go from scan to writer,
    so only the former are shuffled."""
    c = F.coalesce(changes, F.lit(False))
    return table.where(c), table.where(~c)


def recheck(table: DataFrame, outcomes: DataFrame, today, limit: int | None = None) -> DataFrame:
    """M3: apply probe outcomes to the due listings.

    * alive: ``last_checked_at`` = today.
    * gone: status from the expiry (F9), ``gone_at`` = ``last_checked_at`` = today.
    * unknown or no probe: unchanged (stays due).
    Rows that are terminal or not due are never changed and never joined. ``outcomes`` has
    ``(ads_id, outcome)`` with one row per id (see ``probe_outcomes``)."""
    due = non_terminal() & LF.due_for_check("first_seen", "last_checked_at", today)
    t, rest = split_open(table, due)
    counts = F.lit(True)
    if limit:
        capped = due_listings(table, today, limit, columns=("ads_id",))
        t = t.join(capped.select(F.col("ads_id").alias("_cap_id")), F.col("ads_id") == F.col("_cap_id"), "left")
        counts = F.col("_cap_id").isNotNull()
    o = outcomes.select(F.col("ads_id").alias("_probe_id"), F.col("outcome").alias("_outcome"))
    j = t.join(o, F.col("ads_id") == F.col("_probe_id"), "left")
    today_d = LF.day_lit(today)
    alive = counts & (F.col("_outcome") == ALIVE)
    gone = counts & (F.col("_outcome") == GONE)
    out = (j
           .withColumn("availability_status",
                       F.when(gone, LF.classify_gone("ad_expiry", today)).otherwise(F.col("availability_status")))
           .withColumn("gone_at", F.when(gone, today_d).otherwise(F.col("gone_at")))
           .withColumn("last_checked_at", F.when(alive | gone, today_d).otherwise(F.col("last_checked_at"))))
    return out.select(*table.columns).union(rest)


def recheck_by_day(table: DataFrame, probe_log: DataFrame) -> DataFrame:
    """M3 over a log of several days: every listing's probes in time order, each judged on its own day.

    The rules are those of ``recheck`` with the probe's day as today: a probe counts only if the listing is not
    gone and due that day; a failed probe changes nothing. The result is the same whether the log comes as one
    batch or as several, as long as batches follow time. Probes without an id or a time are ignored. A listing's
    probes meet in one row, a few a day at most. Terminal listings stay as they are and are never joined.
    """
    outcome = F.when(F.col("n_items") > 0, F.lit(ALIVE)).otherwise(F.lit(GONE))
    log = (probe_log.where(F.col("ads_id").isNotNull() & F.col("checked_at").isNotNull() & F.col("http_ok"))
           .select(F.col("ads_id").alias("_probe_id"), F.struct("checked_at", outcome.alias("outcome")).alias("p"))
           .groupBy("_probe_id").agg(F.sort_array(F.collect_set("p")).alias("_probes")))
    t, rest = split_open(table, non_terminal())
    j = t.join(log, F.col("ads_id") == F.col("_probe_id"), "left")
    start = F.struct(F.col("availability_status").alias("status"), F.col("last_checked_at").alias("last"),
                     F.col("gone_at").alias("gone"))

    def step(state: Column, probe: Column) -> Column:
        day = F.to_date(probe["checked_at"])
        status = state["status"]
        due = (status.isNull() | ~status.isin(*K.TERMINAL_STATUSES)) & \
            LF.due_for_check(F.col("first_seen"), state["last"], day)
        gone = due & (probe["outcome"] == GONE)
        return F.struct(F.when(gone, LF.classify_gone(F.col("ad_expiry"), day)).otherwise(status).alias("status"),
                        F.when(due, day).otherwise(state["last"]).alias("last"),
                        F.when(gone, day).otherwise(state["gone"]).alias("gone"))

    none = F.array().cast("array<struct<checked_at:timestamp,outcome:string>>")
    j = j.withColumn("_state", F.aggregate(F.coalesce("_probes", none), start, step))
    return (j.withColumn("availability_status", F.col("_state.status"))
            .withColumn("last_checked_at", F.col("_state.last")).withColumn("gone_at", F.col("_state.gone"))
            .select(*table.columns).union(rest))


def probe_counters(probe_log: DataFrame) -> DataFrame:
    """A10 of a re-check: probes per day that found the listing, found it gone, or failed."""
    failed = F.col("http_ok").isNull() | ~F.col("http_ok")
    return probe_log.groupBy(F.to_date("checked_at").alias("day")).agg(
        F.count(F.when(~failed & (F.col("n_items") > 0), 1)).alias("n_alive"),
        F.count(F.when(~failed & ~F.coalesce(F.col("n_items") > 0, F.lit(False)), 1)).alias("n_gone"),
        F.count(F.when(failed, 1)).alias("n_failed"))


def apply_snapshot(table: DataFrame, diff: DataFrame, day) -> tuple[DataFrame, DataFrame]:
    """J8 applied: the table with the check date of ``present`` listings moved on to ``day`` (never back), and the
    ``absent`` ones as the list of listings to probe (ads_id, ad_expiry). ``unverified`` ones stay as they are."""
    marks = diff.select(F.col("ads_id").alias("_diff_id"), "diff")
    j = table.join(marks, table["ads_id"] == marks["_diff_id"], "left")
    moved = F.when(F.col("diff") == "present", F.greatest("last_checked_at", LF.day_lit(day))) \
        .otherwise(F.col("last_checked_at"))
    return (j.withColumn("last_checked_at", moved).select(*table.columns),
            j.where(F.col("diff") == "absent").select("ads_id", "ad_expiry"))


def snapshot_diff(table: DataFrame, fresh: DataFrame, completed: DataFrame,
                  slice_cols: Sequence[str] = ("state", "property_type_id")) -> DataFrame:
    """J8 + U2: compare the active listings with a fresh full pull.

    For every non-terminal listing: ``present`` when its id is in the fresh pull (bulk
    check-date bump), ``absent`` when it is not and its slice completed (a candidate for
    gone), ``unverified`` when its slice did not complete (absence proves nothing).
    ``completed`` lists the slices known to be complete, from recorded totals (``completed_slices``); having some
    rows of a slice is no proof.
    Output: ``(ads_id, *slice_cols, diff)``."""
    slice_cols = list(slice_cols)
    active = table.where(non_terminal()).select("ads_id", *slice_cols)
    seen = fresh.select(F.col("ads_id").alias("_seen_id")).distinct()
    done = completed.select(*[F.col(c).alias(f"_done_{c}") for c in slice_cols]).distinct().withColumn("_done", F.lit(True))
    j = active.join(seen, active["ads_id"] == seen["_seen_id"], "left")
    cond = None
    for c in slice_cols:
        e = j[c].eqNullSafe(done[f"_done_{c}"])
        cond = e if cond is None else cond & e
    j = j.join(done, cond, "left")
    diff = (F.when(F.col("_seen_id").isNotNull(), F.lit("present"))
            .when(F.col("_done").isNotNull(), F.lit("absent"))
            .otherwise(F.lit("unverified")))
    return j.select("ads_id", *slice_cols, diff.alias("diff"))


def availability_summary(table: DataFrame, by: Sequence[str] = ("state",)) -> DataFrame:
    """Listings per status per group, statuses as columns (fixed list, so the pivot
    needs no extra pass to find its values)."""
    statuses = [K.STATUS_ACTIVE, K.STATUS_RENTED, K.STATUS_EXPIRED]
    s = F.coalesce(F.col("availability_status"), F.lit(K.STATUS_ACTIVE))
    aggs = [F.count(F.when(s == v, 1)).alias(f"n_{v}") for v in statuses]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("n_total"), *aggs)
