import os
import tempfile
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dimfold.session import build_session

    os.environ.setdefault("DIMFOLD_WAREHOUSE", tempfile.mkdtemp(prefix="dimfold-wh-"))
    s = build_session("local[4]", shuffle_partitions=4, app_name="dimfold-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame (optionally of some columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
