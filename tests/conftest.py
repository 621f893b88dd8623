import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiofact.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))

    return collect
