"""Loading into the fact table: key checks, conformance, schema evolution, upsert.

The table is immutable between versions: an upsert reads the current snapshot and the
incoming batch and returns the next snapshot as a DataFrame (written by the caller,
see ``letwise.sources.snapshot``).

Shuffle plan of ``upsert``: the batch is reduced to one row per key by an aggregate
on ``ads_id`` (partial aggregation before the shuffle), then full-outer joined with the
table on ``ads_id``. The aggregate's output is already hash-partitioned on the key, so
only the table side is exchanged for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letwise import constants as K
from letwise import functions as LF
from letwise import schemas as S
from letwise.operators.dedup import pick_per_key


class MissingKeyError(ValueError):
    """The incoming frame has no key column."""


def require_key(df: DataFrame, key: str = S.KEY) -> None:
    """Fail before any work when the key column is absent."""
    if key not in df.columns:
        raise MissingKeyError(f"the batch has no key column {key!r}")


def split_quarantine(df: DataFrame, key: str = S.KEY) -> tuple[DataFrame, DataFrame]:
    """Rows with a NULL or blank key go to quarantine instead of the table."""
    bad = F.col(key).isNull() | (LF.strip(key) == "")
    return df.where(~bad), df.where(bad)


def _typed(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    """A column of ``df`` conformed to the target type, or a typed NULL when absent."""
    if name not in df.columns:
        return F.lit(None).cast(dtype).alias(name)
    src = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DoubleType):
        if isinstance(src, T.StringType):
            c = LF.parse_number(c)
        else:
            c = c.cast("double")
        c = LF.nan_to_null(c)
    elif isinstance(dtype, T.DateType):
        c = c if isinstance(src, T.DateType) else LF.parse_day(c)
    elif isinstance(dtype, T.StringType):
        if isinstance(src, (T.DoubleType, T.FloatType)):
            c = LF.nan_to_null(c)
        c = c.cast("string")
    else:
        c = c.cast(dtype)
    return c.alias(name)


def conform(df: DataFrame, columns: Sequence[str] = S.SCRAPE_COLUMNS,
            types: dict = S.TABLE_TYPES, keep: Sequence[str] = ()) -> DataFrame:
    """P8 + P9: add missing target columns as NULL, drop extras, order as the target,
    type each column (NaN -> NULL). ``keep`` names extra columns to carry along."""
    return df.select(*[_typed(df, c, types[c]) for c in columns], *[F.col(c) for c in keep])


def evolve_schema(table: DataFrame) -> DataFrame:
    """M4: add every missing target column as a typed NULL. When a re-check column was
    missing, seed old rows: ``first_seen = scrape_date`` and status ``active``."""
    missing = [c for c in S.TABLE_COLUMNS if c not in table.columns]
    out = conform(table, S.TABLE_COLUMNS, S.TABLE_TYPES)
    if any(c in S.RECHECK_COLUMNS for c in missing):
        out = out.withColumn("first_seen", F.coalesce(F.col("first_seen"), LF.parse_day("scrape_date")))
        out = out.withColumn("availability_status",
                             F.coalesce(F.col("availability_status"), F.lit(K.STATUS_ACTIVE)))
    return out


def prepare_batch(batch: DataFrame, order_cols: Sequence[str] = ("scrape_date", "load_key")) -> DataFrame:
    """Type the batch's own columns, keep the latest row per key (R2), then conform to
    the scrape columns, with ``_first_day``: the key's earliest scrape day in the batch. ``order_cols`` are
    columns of the batch (scrape date, then file and position) compared in order; the rest of the row breaks
    ties so the result never depends on input order. Absent columns are added only after the
    aggregation, so the shuffled rows carry no NULL placeholders."""
    require_key(batch)
    present = [c for c in S.SCRAPE_COLUMNS if c in batch.columns]
    extra = [c for c in order_cols if c not in S.SCRAPE_COLUMNS and c in batch.columns]
    typed = batch.select(*[_typed(batch, c, S.TABLE_TYPES[c]) for c in present], *extra)
    day = LF.parse_day("scrape_date") if "scrape_date" in present else F.lit(None).cast("date")
    picked = pick_per_key(typed, [S.KEY], [c for c in order_cols if c in typed.columns],
                          also=[F.min(day).alias("_first_day")])
    return conform(picked, S.SCRAPE_COLUMNS, S.TABLE_TYPES, keep=["_first_day"])


def _rank(prefix: str, order_cols: Sequence[str]) -> Column:
    """The order in which ``prepare_batch`` compares rows, for a conformed row."""
    first = [c for c in order_cols if c in S.SCRAPE_COLUMNS]
    rest = [c for c in S.SCRAPE_COLUMNS if c not in first and c != S.KEY]
    return F.struct(*[F.col(f"{prefix}{c}").alias(f"o{i}") for i, c in enumerate([*first, *rest])])


def upsert(table: DataFrame | None, batch: DataFrame,
           order_cols: Sequence[str] = ("scrape_date", "load_key"), guard_late: bool = True) -> DataFrame:
    """M1: merge a batch into the table on ``ads_id``.

    * insert: scrape columns from the batch, ``first_seen`` = the key's earliest scrape day in the batch, status
      active; ``last_checked_at`` = the row's own day if that is later.
    * conflict: every scrape column replaced by the batch's (NULL included, T12); ``first_seen`` untouched
      (T13). A later scrape day moves ``last_checked_at`` on, never back. The listing is active again, with
      ``gone_at`` cleared, unless it was checked or gone after the scrape day.
    * with ``guard_late``, a batch row whose scrape date is older than the stored one
      leaves the stored row as it is (late data).
    * rows of one scrape date compare as within a batch: by ``order_cols``, then the rest of the row. The greater one
      stays, whichever batch it came in, and loading a stored row again changes nothing.
    Blank keys must have been split off (``split_quarantine``); the result has the
    table columns in table order.
    """
    b = prepare_batch(batch, order_cols)
    return merge_prepared(table, b.where(F.col(S.KEY).isNotNull()), order_cols, guard_late)


def merge_prepared(table: DataFrame | None, b: DataFrame,
                   order_cols: Sequence[str] = ("scrape_date", "load_key"), guard_late: bool = True) -> DataFrame:
    """``upsert`` of a batch that ``prepare_batch`` has reduced to one row a key, so that a caller who also needs the
    reduced batch makes it once."""
    if table is None:
        # first load: every row is an insert, no join needed
        b = b.withColumn("_b_day", LF.parse_day("scrape_date"))
        return b.select(*S.SCRAPE_COLUMNS, F.col("_first_day").alias("first_seen"),
                        F.when(F.col("_b_day") > F.col("_first_day"), F.col("_b_day")).alias("last_checked_at"),
                        F.lit(K.STATUS_ACTIVE).alias("availability_status"),
                        F.lit(None).cast("date").alias("gone_at"))
    t = evolve_schema(table)

    tb = t.select(*[F.col(c).alias(f"t_{c}") for c in S.TABLE_COLUMNS])
    bb = b.select(*[F.col(c).alias(f"b_{c}") for c in S.SCRAPE_COLUMNS], "_first_day")
    j = tb.join(bb, tb[f"t_{S.KEY}"] == bb[f"b_{S.KEY}"], "full_outer")

    # flags computed once; the final projection only references them
    j = (j.withColumn("_in_table", F.col(f"t_{S.KEY}").isNotNull())
          .withColumn("_b_day", LF.parse_day(F.col("b_scrape_date")))
          .withColumn("_t_day", LF.parse_day(F.col("t_scrape_date"))))
    in_table, b_day, t_day = F.col("_in_table"), F.col("_b_day"), F.col("_t_day")
    if guard_late:
        late = in_table & b_day.isNotNull() & t_day.isNotNull() & (b_day < t_day)
    else:
        late = F.lit(False)
    beaten = in_table & b_day.isNotNull() & t_day.isNotNull() & (b_day == t_day) & \
        ~(_rank("b_", order_cols) > _rank("t_", order_cols))
    j = j.withColumn("_take", F.col(f"b_{S.KEY}").isNotNull() & ~late & ~beaten)
    take = F.col("_take")
    j = j.withColumn("_later", in_table & take & b_day.isNotNull() & (t_day.isNull() | (b_day > t_day)))
    last_event = F.greatest(F.col("t_last_checked_at"), F.col("t_gone_at"))
    j = j.withColumn("_revive", take & (~in_table | b_day.isNull() | last_event.isNull() | (b_day >= last_event)))
    revive = F.col("_revive")

    cols = [F.when(take, F.col(f"b_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in S.SCRAPE_COLUMNS]
    cols.append(F.when(take & ~in_table, F.col("_first_day")).otherwise(F.col("t_first_seen")).alias("first_seen"))
    cols.append(
        F.when(F.col("_later"), F.greatest(F.col("t_last_checked_at"), b_day))
        .when(take & ~in_table, F.when(b_day > F.col("_first_day"), b_day))
        .otherwise(F.col("t_last_checked_at")).alias("last_checked_at"))
    cols.append(F.when(revive, F.lit(K.STATUS_ACTIVE)).otherwise(F.col("t_availability_status")).alias("availability_status"))
    cols.append(F.when(revive, F.lit(None).cast("date")).otherwise(F.col("t_gone_at")).alias("gone_at"))
    return j.select(*cols)
