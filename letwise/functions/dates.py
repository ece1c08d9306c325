"""Date handling: parsing, the published-date format, re-check cadence, gone class."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from letwise import constants as K
from letwise.functions.text import _c

# Published-date inputs accepted: an ISO or a day-first date, and perhaps a time with or without seconds.
_TIME = r"( ([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?)?$"
PUBLISHED_IN = (("^[0-9]{4}-[0-9]{2}-[0-9]{2}" + _TIME, "yyyy-MM-dd"),
                ("^[0-9]{2}/[0-9]{2}/[0-9]{4}" + _TIME, "dd/MM/yyyy"))


def day_lit(day) -> Column:
    """A date literal from a ``date`` or ``'yyyy-MM-dd'`` text; a column is used as it is."""
    if isinstance(day, Column):
        return day
    if isinstance(day, _dt.date):
        day = day.isoformat()
    return F.to_date(F.lit(str(day)))


def parse_day(x) -> Column:
    """date from the first 10 characters (``yyyy-MM-dd``), else NULL. Blank -> NULL.

    Date-typed input is used as is."""
    c = _c(x)
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), K.DAY_FORMAT)


def publish_date(x) -> Column:
    """the published date as ``MM/dd/yyyy``; ``''`` when no accepted form matches.

    Each row is parsed on its own (order-free). Its shape is tested first, so that the date is parsed once
    and texts of other shapes are not parsed at all."""
    c = _c(x).cast("string")
    day = F.substring(c, 1, 10)
    parsed = F.coalesce(*[F.when(c.rlike(shape), F.try_to_date(day, fmt)) for shape, fmt in PUBLISHED_IN])
    return F.coalesce(F.date_format(parsed, K.PUBLISHED_OUT_FORMAT), F.lit(""))


def age_days(first_seen, today) -> Column:
    """days since first seen; a missing or bad first_seen counts as today (age 0)."""
    t = day_lit(today)
    return F.datediff(t, F.coalesce(parse_day(first_seen), t))


def recheck_interval(age, policy=K.RECHECK_DECAY) -> Column:
    """F8: the decay interval for an age in days, built from the policy list."""
    age = _c(age)
    out = None
    catch_all = None
    for age_lt, days in policy:
        if age_lt is None:
            catch_all = days
            continue
        out = F.when(age < age_lt, F.lit(days)) if out is None else out.when(age < age_lt, F.lit(days))
    if out is None:
        return F.lit(catch_all)
    return out.otherwise(F.lit(catch_all))


def due_for_check(first_seen, last_checked_at, today, policy=K.RECHECK_DECAY) -> Column:
    """Never checked (missing/blank) -> due; unparseable check date -> due;
    else due when days since the last check reach the interval for the listing's age."""
    last_raw = _c(last_checked_at)
    last = parse_day(last_raw)
    interval = recheck_interval(age_days(first_seen, today), policy)
    since = F.datediff(day_lit(today), last)
    return (
        F.when(last_raw.isNull() | (last_raw.cast("string") == ""), F.lit(True))
        .when(last.isNull(), F.lit(True))
        .otherwise(since >= interval)
    )


def classify_gone(ad_expiry, today) -> Column:
    """a listing that disappeared before its expiry day was ``rented``; on or after it,
    or with a missing/unparseable expiry, it ``expired``."""
    expiry_day = F.try_to_date(_c(ad_expiry).cast("string"), K.AD_EXPIRY_FORMAT)
    return F.when(day_lit(today) < expiry_day, F.lit(K.STATUS_RENTED)).otherwise(F.lit(K.STATUS_EXPIRED))
