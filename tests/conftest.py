import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import local_session
    s = local_session("*", shuffle_partitions=8, app="quayside-tests", driver_memory="4g")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
