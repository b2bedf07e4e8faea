from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import local_session  # noqa: E402

from waitline.plans.store import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def store(spark):
    return Store(spark)
