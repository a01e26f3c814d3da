import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridseries.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="gridseries-tests")
    yield s


def rows(df, *cols):
    """Collect a small test result as sorted tuples."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
