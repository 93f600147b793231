import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "larder-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path


def rows(df, *order):
    """All rows as tuples, sorted by the given columns (or by everything)."""
    got = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(got, key=lambda r: tuple(str(r[i]) for i in at))
    return sorted(got, key=str)
