import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pitlane.config import local_session, shared_dir

    s = local_session(cores="4", shuffle_partitions=4, app="pitlane-tests")
    shared_dir(s)  # sets a private checkpoint folder only when none is configured
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns if none)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
