import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from reeflens.session import get_session
    s = get_session("local[4]", 4, app_name="reeflens-tests",
                    extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="reeflens-tests-")})
    yield s


@pytest.fixture
def rows():
    """Collect a DataFrame as a list of dicts sorted by the given columns."""
    def _rows(df, *order):
        out = [r.asDict() for r in df.collect()]
        if order:
            out.sort(key=lambda d: tuple((d[c] is None, d[c]) for c in order))
        return out
    return _rows
