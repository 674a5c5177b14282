import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from earshot.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "earshot-tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder for the files of one test."""
    return tempfile.mkdtemp(prefix="earshot-test-")


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, sorted."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
