import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from growthlens.session import build_session

    session = build_session(master="local[4]", app_name="growthlens-tests", shuffle_partitions=4)
    yield session
    session.stop()


def rows(df, *cols):
    """Collect ``cols`` (default all) as a list of tuples, in the frame's order."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
