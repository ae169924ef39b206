import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from uptide.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *columns):
    """Rows as tuples, sorted with NULLs last."""
    data = [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))
