from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from perfspark.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, "tests", **{"spark.checkpoint.dir": str(shared)})
    yield session
    session.stop()
