import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from letwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="letwise-tests")
    yield s


def rows(df, *cols):
    """Collect selected columns as a list of tuples (in DataFrame order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
