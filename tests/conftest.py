import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import get_session
    s = get_session(app="tripmart-tests", master="local[8]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def dims(spark):
    from tripmart.operators.dims import build_dims
    return build_dims(spark)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as text (what ``explain`` prints)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
