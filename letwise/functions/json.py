"""JSON attribute extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letwise.functions.text import _c


def json_attribute(x, name: str) -> Column:
    """The text of one top-level attribute of a JSON object text; NULL when absent
    or the text is not an object."""
    return F.get_json_object(_c(x), f"$.{name}")


def json_fields(x, schema) -> Column:
    """Parse a JSON object text into a struct of the given schema."""
    return F.from_json(_c(x), schema, {"mode": "PERMISSIVE"})
