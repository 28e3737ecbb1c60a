import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="vigil-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((1, 0) if x is None else (0, x) for x in t))
