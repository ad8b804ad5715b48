import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cropscope.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="cropscope-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small test result as a list of tuples in the given column order."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
