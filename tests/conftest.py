import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmpdir_path():
    # a fresh scratch folder per test (never cleared, never reused)
    return tempfile.mkdtemp(prefix="ledgerloom-test-")


def rows(df, *cols):
    """Sorted tuples of the selected columns (NULLs sort first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
