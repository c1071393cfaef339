from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from gritmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(scratch=str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
