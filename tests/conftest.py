import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="ledgerline-tests")
    yield s


def rows(df, order=None):
    """Collected rows as plain tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))
