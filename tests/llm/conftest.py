from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    """Python workers import the package from this folder."""
    known = os.environ.get("PYTHONPATH", "")
    spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}{os.pathsep}{known}".rstrip(os.pathsep)
