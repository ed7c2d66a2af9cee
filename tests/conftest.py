from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quillcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("quillcast-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"
