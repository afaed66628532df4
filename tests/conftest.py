import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app_name="pitchlake-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder below the session's checkpoint folder."""
    from pitchlake.session import scratch_path

    return scratch_path(spark, "test")


def rows(df, *cols):
    """Collected rows as sorted tuples (NULL-safe ordering)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((True, 0) if x is None else (False, x) for x in t))
