import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Collected rows of a frame as sorted tuples."""
    return lambda frame: sorted((tuple(row) for row in frame.collect()), key=repr)
