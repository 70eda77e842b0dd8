import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import build_session
    ckpt = tempfile.mkdtemp(prefix="shelfcast-test-ckpt-")
    s = build_session("local[4]", 4, app_name="shelfcast-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (default all) as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
