"""SQL fragments for the DuckDB oracle: the same rules as the column library, written as
plain SQL text. Used only by ``oracle_sql()``."""

from __future__ import annotations

from letwise import constants as K
from letwise.functions.text import NUMERIC_PATTERN


def q(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def parse_number(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, '{NUMERIC_PATTERN}') THEN CAST(trim({s}) AS DOUBLE) END)"


def clean_rent(x: str) -> str:
    s = f"replace(replace(replace(CAST({x} AS VARCHAR), {q(K.RENT_PREFIX)}, ''), {q(K.RENT_SUFFIX)}, ''), ',', '')"
    return parse_number(s)


def clean_size(x: str) -> str:
    s = f"replace(replace(CAST({x} AS VARCHAR), {q(K.SIZE_SUFFIX)}, ''), ',', '')"
    return parse_number(s)


def clean_rooms(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    return (f"(CASE WHEN {s} IS NULL OR {s} = '' THEN NULL "
            f"WHEN regexp_matches({s}, '{NUMERIC_PATTERN}') THEN CAST(CAST(trunc(CAST({s} AS DOUBLE)) AS BIGINT) AS VARCHAR) "
            f"ELSE {s} END)")


def strip_category(x: str) -> str:
    return f"replace(coalesce({x}, ''), {q(K.CATEGORY_SUFFIX)}, '')"


_PUB_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y")


def publish_date(x: str) -> str:
    tries = ", ".join(f"try_strptime({x}, '{f}')" for f in _PUB_FORMATS)
    return f"coalesce(strftime(coalesce({tries}), '%m/%d/%Y'), '')"


def parse_day(x: str) -> str:
    return f"CAST(try_strptime(substr(CAST({x} AS VARCHAR), 1, 10), '%Y-%m-%d') AS DATE)"


def day(d: str) -> str:
    return f"DATE '{d}'"


def interval(age: str) -> str:
    parts = []
    catch_all = None
    for lt, days in K.RECHECK_DECAY:
        if lt is None:
            catch_all = days
        else:
            parts.append(f"WHEN {age} < {lt} THEN {days}")
    return f"(CASE {' '.join(parts)} ELSE {catch_all} END)"


def age_days(first_seen: str, today: str) -> str:
    return f"date_diff('day', coalesce({parse_day(first_seen)}, {day(today)}), {day(today)})"


def due(first_seen: str, last: str, status: str, today: str) -> str:
    last_d = parse_day(last)
    non_terminal = f"({status} IS NULL OR {status} NOT IN ({in_list(K.TERMINAL_STATUSES)}))"
    rule = (f"(CASE WHEN {last} IS NULL OR CAST({last} AS VARCHAR) = '' THEN TRUE "
            f"WHEN {last_d} IS NULL THEN TRUE "
            f"ELSE date_diff('day', {last_d}, {day(today)}) >= {interval(age_days(first_seen, today))} END)")
    return f"({non_terminal} AND {rule})"


def classify_gone(expiry: str, today: str) -> str:
    return (f"(CASE WHEN {day(today)} < CAST(try_strptime(CAST({expiry} AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS DATE) "
            f"THEN 'rented' ELSE 'expired' END)")


def exact_mean(x: str) -> str:
    # whole cents in integers, a rule of its own; the test tables have money of two decimals
    return f"(CASE WHEN count({x}) > 0 THEN CAST(sum(CAST(round({x} * 100) AS HUGEINT)) AS DOUBLE) / 100 / count({x}) END)"


def rent_summary_aggs(x: str = "monthly_rent") -> str:
    return (f"count(*) AS n_listings, count({x}) AS n_rent, {exact_mean(x)} AS mean_rent, "
            f"median({x}) AS median_rent")


def mapping_values() -> str:
    """The fixed type mapping as a VALUES list, one row per key (last wins)."""
    d: dict[str, str] = {}
    for raw, std in K.TYPE_MAPPING:
        if raw is None or std is None:
            continue
        for piece in str(raw).split("\n"):
            piece = piece.strip()
            if piece:
                d[piece] = std
    rows = ", ".join(f"({q(k)}, {q(v)})" for k, v in d.items())
    return f"(VALUES {rows}) AS m(key, std)"


def standard_type(col: str) -> str:
    return f"(CASE WHEN {col} IS NULL THEN 'Other' ELSE coalesce(m.std, 'Other') END)"


def ymd(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"
