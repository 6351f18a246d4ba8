import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridpulse.session import local_session
    s = local_session("*", shuffle_partitions=8, app="gridpulse-tests")
    yield s
    s.stop()


def rows(df, *order):
    """Collect a small test result as a list of dicts (tests only)."""
    if order:
        df = df.orderBy(*order)
    return [r.asDict() for r in df.collect()]
