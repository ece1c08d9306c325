"""ST4 with state and timers: availability kept per listing in the stream itself, so that nothing is rewritten per
micro-batch.

``availability_changes`` turns a stream of probes into a stream of changes. Listings are dealt over ``BUCKETS`` buckets by
a hash of ``ads_id``; a bucket is one key of Spark's state store and holds a small row a listing, for a call of the
processor costs milliseconds whatever it does. The state starts from the table. The rules are those of
``recheck_by_day``: a probe counts only if the listing is not terminal and is due on the probe's day, and a failed probe
changes nothing. With ``expire`` an event-time timer stands at a bucket's next expiry: once the watermark passes it, all
listings that are still there expire on their days without any probe. A probe later than the expiry finds it expired,
whether the timer has fired yet or not, so the result does not depend on how the log is cut into micro-batches.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from letwise import constants as K
from letwise import schemas as S
from letwise.operators.availability import ALIVE, GONE, non_terminal
from letwise.operators.dedup import latest_per_key
from letwise.session import ship_package

# a bucket's listings as a JSON object by ads_id: [status, first_seen, last_checked, gone_at, expiry_day, expires, n_changes],
# days as yyyy-MM-dd, which compare as text; the expiry also as milliseconds for the timer (-1: none)
STATE = "listings string"
BUCKETS = 4096
CHANGE = "ads_id string, change_no long, cause string, availability_status string, last_checked_at string, gone_at string"
BY_PROBE, BY_TIMER = "probe", "expiry"
_PROVIDER = ("spark.sql.streaming.stateStore.providerClass",
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def is_due(status: str | None, first_seen: str | None, last_checked: str | None, day: str) -> bool:
    """W3 + W4 for one listing: not terminal, and never checked or not since the interval of its age."""
    if status in K.TERMINAL_STATUSES:
        return False
    if last_checked is None:
        return True
    today = dt.date.fromisoformat(day)
    age = (today - dt.date.fromisoformat(first_seen)).days if first_seen else 0
    interval = next(days for below, days in K.RECHECK_DECAY if below is None or age < below)
    return (today - dt.date.fromisoformat(last_checked)).days >= interval


class Availability(StatefulProcessor):
    """The state machine of the listings of one bucket."""

    def __init__(self, expire: bool):
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", STATE)

    def _listings(self) -> dict[str, list]:
        state = self.bucket.get()
        return {} if state is None else json.loads(state[0])

    def _keep(self, listings: dict[str, list]) -> None:
        self.bucket.update((json.dumps(listings),))

    def _pending(self, state: list) -> bool:
        return self.expire and state[5] >= 0 and state[0] not in K.TERMINAL_STATUSES

    def _wait(self, listings: dict[str, list]) -> None:
        """A timer at the next expiry of the bucket."""
        expiries = [state[5] for state in listings.values() if self._pending(state)]
        if expiries:
            self.handle.registerTimer(min(expiries))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        listings = self._listings()   # a bucket's rows may come in several frames
        text = [initialState[c] for c in ("status", "first_seen", "last_checked", "gone_at", "expiry_day")]
        for ads_id, expires, *row in zip(initialState[S.KEY], initialState["expires"], *text):
            listings.setdefault(str(ads_id), [*(None if pd.isna(x) else str(x) for x in row), int(expires), 0])
        self._keep(listings)
        self._wait(listings)

    def _expired(self, ads_id: str, state: list) -> dict:
        """The change at a listing's expiry; its day is that of the expiry."""
        state[0], state[3] = K.STATUS_EXPIRED, state[4]
        return self._change(ads_id, state, BY_TIMER)

    def _change(self, ads_id: str, state: list, cause: str) -> dict:
        state[6] += 1
        return {"ads_id": ads_id, "change_no": state[6], "cause": cause, "availability_status": state[0], "last_checked_at": state[2],
                "gone_at": state[3]}

    def _emit(self, listings: dict[str, list], changes: list[dict]) -> Iterator[pd.DataFrame]:
        if changes:
            self._keep(listings)
            yield pd.DataFrame(changes)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        probes = sorted({(i, int(a), o, d) for r in rows for i, a, o, d in zip(r[S.KEY], r["at"], r["outcome"], r["day"])})
        listings, changes = self._listings(), []
        for ads_id, at, outcome, day in probes:
            state = listings.get(ads_id)
            if state is None:  # not a listing of the table, or gone before the stream began
                continue
            if self._pending(state) and state[5] <= at:
                changes.append(self._expired(ads_id, state))
            if not is_due(state[0], state[1], state[2], day):
                continue
            state[2] = day
            if outcome == GONE:
                state[0] = K.STATUS_RENTED if state[4] is not None and day < state[4] else K.STATUS_EXPIRED
                state[3] = day
            changes.append(self._change(ads_id, state, BY_PROBE))
        yield from self._emit(listings, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        listings, now = self._listings(), timerValues.getCurrentWatermarkInMs()
        changes = [self._expired(ads_id, state) for ads_id, state in listings.items() if self._pending(state) and state[5] <= now]
        yield from self._emit(listings, changes)
        self._wait(listings)

    def close(self) -> None:
        pass


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(S.KEY), F.lit(buckets)).cast("int").alias("bucket")


def _start_state(table: DataFrame, buckets: int) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    expiry = F.try_to_timestamp(F.col("ad_expiry").cast("string"), F.lit(K.AD_EXPIRY_FORMAT))
    return table.where(F.col(S.KEY).isNotNull() & non_terminal()).select(   # terminal ones never change here
        _bucket(buckets), S.KEY, F.col("availability_status").alias("status"), day("first_seen").alias("first_seen"), day("last_checked_at").alias("last_checked"),
        day("gone_at").alias("gone_at"), day(expiry).alias("expiry_day"), F.coalesce(F.unix_millis(expiry), F.lit(-1)).alias("expires"))


def availability_changes(probes: DataFrame, table: DataFrame, delay: str = "0 seconds", expire: bool = True,
                         buckets: int = BUCKETS) -> DataFrame:
    """A stream of changes (``CHANGE``) from a stream of probes and the table they start from (unique ``ads_id``). Probes
    that failed, or lack an id or a time, change nothing; those later than ``delay`` behind the newest are late and
    dropped by the watermark. Probes of listings that the table does not hold, or holds as terminal, are ignored.
    A micro-batch rewrites the state of the buckets it probes; like the number of shuffle partitions, ``buckets`` must stay
    the same for a checkpoint, and checkpoints of a state by listing cannot be continued."""
    ship_package(probes.sparkSession)
    outcome = F.when(F.col("n_items") > 0, F.lit(ALIVE)).otherwise(F.lit(GONE))
    # failed probes pass the watermark like all others: time goes on
    seen = probes.withWatermark("checked_at", delay).where(F.col(S.KEY).isNotNull() & F.col("checked_at").isNotNull() & F.col("http_ok"))
    seen = seen.select(_bucket(buckets), S.KEY, "checked_at", F.unix_millis("checked_at").alias("at"), F.date_format("checked_at", "yyyy-MM-dd").alias("day"),
                       outcome.alias("outcome"))
    return seen.groupBy("bucket").transformWithStateInPandas(Availability(expire), CHANGE, "Append", "EventTime",
                                                          initialState=_start_state(table, buckets).groupBy("bucket"))


def track_availability(spark: SparkSession, probes: DataFrame, table: DataFrame, sink_dir: str, checkpoint: str,
                       delay: str = "0 seconds", expire: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """ST4: run ``availability_changes`` over what has arrived and append the changes to ``sink_dir`` (Parquet, exactly
    once). Timers need Spark's RocksDB state store, which is set for this query only."""
    before = spark.conf.get(_PROVIDER[0], None)
    spark.conf.set(*_PROVIDER)
    try:
        q = (availability_changes(probes, table, delay, expire, buckets).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink_dir))
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER[0])
        else:
            spark.conf.set(_PROVIDER[0], before)
    q.awaitTermination()
    return q


def apply_changes(table: DataFrame, changes: DataFrame) -> DataFrame:
    """The table with the last change of every listing applied; all other columns and rows as they are."""
    last = latest_per_key(changes, [S.KEY], ["change_no"]).select(
        F.col(S.KEY).alias("_changed"), F.col("availability_status").alias("_status"), F.to_date("last_checked_at").alias("_last"),
        F.to_date("gone_at").alias("_gone"))
    j = table.join(last, table[S.KEY] == last["_changed"], "left")
    new = {"availability_status": "_status", "last_checked_at": "_last", "gone_at": "_gone"}
    changed = F.col("_changed").isNotNull()
    return j.select(*[F.when(changed, F.col(new[c])).otherwise(table[c]).alias(c) if c in new else table[c] for c in table.columns])
