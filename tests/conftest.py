import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskmesh.session import build_session
    s = build_session("local[4]", app="riskmesh-tests", shuffle_partitions=4,
                      **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="riskmesh-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="riskmesh-test-")


def rows(df, *cols):
    """Collected rows as tuples, sorted, optionally restricted to columns."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
