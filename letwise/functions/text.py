"""Text cleaning and composition as plain ``Column -> Column`` expressions.

All of these stay inside whole-stage codegen: no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letwise import constants as K

# What Python's float() accepts as a plain decimal number, and nothing else
# (no nan/inf, no underscores, no Java suffixes such as 1200d).
NUMERIC_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

# Characters Python's str.strip() removes by default (ASCII whitespace).
_WS = " \t\n\r\x0b\x0c"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Remove leading/trailing whitespace, like Python's ``str.strip()``."""
    return F.btrim(_c(x).cast("string"), F.lit(_WS))


def blank_to_null(x) -> Column:
    """``''`` (after nothing else) becomes NULL."""
    c = _c(x)
    return F.when(c != "", c)


def is_present(x) -> Column:
    """Python truthiness of a text value: not NULL and not empty."""
    c = _c(x)
    return c.isNotNull() & (c != "")


def na_to_null(x, tokens=K.NA_TOKENS) -> Column:
    """Text that a pandas CSV read turns into a missing value becomes NULL (P10).
    Matching is exact, as in pandas (no stripping)."""
    c = _c(x)
    return F.when(~c.isin(*tokens), c)


def nan_to_null(x) -> Column:
    """Double NaN becomes NULL."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def parse_number(x) -> Column:
    """Guarded text -> double: NULL for anything Python's float() would reject, and
    for nan/inf/underscore forms that differ between engines (T5)."""
    s = _c(x).cast("string")
    return F.when(s.rlike(NUMERIC_PATTERN), strip(s).try_cast("double"))


def clean_rent(x) -> Column:
    """F1: ``'RM 1,200 per month'`` -> 1200.0; anything else unparseable -> NULL."""
    s = _c(x).cast("string")
    s = F.replace(s, F.lit(K.RENT_PREFIX), F.lit(""))
    s = F.replace(s, F.lit(K.RENT_SUFFIX), F.lit(""))
    s = F.replace(s, F.lit(","), F.lit(""))
    return parse_number(s)


def clean_size(x) -> Column:
    """F2: ``'1,200 sq.ft.'`` -> 1200.0; anything else unparseable -> NULL."""
    s = _c(x).cast("string")
    s = F.replace(s, F.lit(K.SIZE_SUFFIX), F.lit(""))
    s = F.replace(s, F.lit(","), F.lit(""))
    return parse_number(s)


def clean_rooms(x) -> Column:
    """numeric text -> truncated integer text (``'3.0'`` -> ``'3'``); blank -> NULL;
    any other label is kept, stripped (``'More than 10'``)."""
    s = strip(x)
    as_int = s.try_cast("double").try_cast("bigint").cast("string")
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when(s.rlike(NUMERIC_PATTERN), as_int)
        .otherwise(s)
    )


def strip_category(x) -> Column:
    """NULL -> ``''``, then remove every literal ``', For rent'``."""
    return F.replace(F.coalesce(_c(x).cast("string"), F.lit("")), F.lit(K.CATEGORY_SUFFIX), F.lit(""))


def list_or_scalar_text(x) -> Column:
    """A JSON array text becomes its elements joined by ``', '``; a scalar its text;
    missing becomes ``''``."""
    c = _c(x).cast("string")
    arr = F.from_json(c, "array<string>")
    return (
        F.when(c.isNull(), F.lit(""))
        .when(strip(c).startswith("[") & arr.isNotNull(), F.array_join(arr, ", "))
        .otherwise(c)
    )


def rent_label(price_label) -> Column:
    """``'RM 2,000'`` -> ``'RM 2,000 per month'``; ``''`` when the label is missing."""
    p = _c(price_label)
    return F.when(is_present(p), F.concat(p, F.lit(K.RENT_SUFFIX))).otherwise(F.lit(""))


def size_label(size, suffix) -> Column:
    """``'719'`` + ``'sq.ft.'`` -> ``'719 sq.ft.'``; ``''`` when size is missing or 0."""
    s = _c(size)
    present = is_present(s) & (s != "0")
    return F.when(present, strip(F.concat_ws(" ", s, _c(suffix)))).otherwise(F.lit(""))


def category_label(category) -> Column:
    """``'Room'`` -> ``'Room, For rent'``; ``''`` when missing."""
    c = _c(category)
    return F.when(is_present(c), F.concat(c, F.lit(K.CATEGORY_SUFFIX))).otherwise(F.lit(""))


def address(*parts) -> Column:
    """Join the non-blank parts with ``', '`` (kept parts are not trimmed)."""
    cols = [_c(p) for p in parts]
    return F.concat_ws(", ", *[F.when(strip(c) != "", c) for c in cols])


def geocode_query(*parts, country: str = K.COUNTRY) -> Column:
    """P5: trimmed non-blank parts joined with ``', '`` plus the country; ``''`` if none."""
    cols = [strip(_c(p)) for p in parts]
    joined = F.concat_ws(", ", *[F.when(c != "", c) for c in cols])
    return F.when(joined == "", F.lit("")).otherwise(F.concat(joined, F.lit(", " + country)))


def first_present(a, b) -> Column:
    """The first of two values that is present, else ``''``."""
    return F.coalesce(blank_to_null(_c(a)), _c(b), F.lit(""))


def slug(x) -> Column:
    """Lower-case, runs of non-word characters -> ``_``, trimmed of ``_``;
    ``'type'`` when nothing is left."""
    s = F.regexp_replace(F.lower(strip(x)), r"(?U)[^\w]+", "_")
    s = F.btrim(s, F.lit("_"))
    return F.when(s == "", F.lit("type")).otherwise(s)


def normalise_state(x) -> Column:
    """State key as used by the region dimension: stripped and lower-cased."""
    return F.lower(strip(F.coalesce(_c(x), F.lit(""))))
