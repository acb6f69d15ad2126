import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from credscope.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=8, app="credscope-tests")
    yield session
    session.stop()


def rows(df, *cols):
    """Collect as a list of tuples (optionally a subset of columns)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
