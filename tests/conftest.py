"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from folioframe.session import get_spark

    session = get_spark("local[4]", 2)
    yield session
    session.stop()
