import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        cols = columns or df.columns
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

    return collect
