"""Scalar column library: every function maps Column(s) to a Column."""

from letwise.functions.dates import (  # noqa: F401
    PUBLISHED_IN,
    age_days,
    classify_gone,
    day_lit,
    due_for_check,
    parse_day,
    publish_date,
    recheck_interval,
)
from letwise.functions.json import json_attribute, json_fields  # noqa: F401
from letwise.functions.text import (  # noqa: F401
    NUMERIC_PATTERN,
    address,
    blank_to_null,
    category_label,
    clean_rent,
    clean_rooms,
    clean_size,
    first_present,
    geocode_query,
    is_present,
    list_or_scalar_text,
    na_to_null,
    nan_to_null,
    normalise_state,
    parse_number,
    rent_label,
    size_label,
    slug,
    strip,
    strip_category,
)
