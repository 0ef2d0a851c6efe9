import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", app="statmart-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never cleared, so a failed test leaves its evidence.
    return tempfile.mkdtemp(prefix="statmart-test-", dir="/tmp")


def rows(df, *cols):
    """Rows as tuples (columns in the given order, or the frame's order)."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
