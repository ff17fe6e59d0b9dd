import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from parley.session import local_session  # noqa: E402
from tables import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="parley-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return collect
