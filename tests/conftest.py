from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tickloom.session import clear_staged, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def tables() -> str:
    return os.environ.get("TICKLOOM_TABLES", "/root/testdata/sf0.01")
