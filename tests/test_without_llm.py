"""The registered queries of a copy of the repository without the text operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import oracles
import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = """
import __spark_entry__ as registered
print(*sorted(registered.queries()), "|", *sorted(registered.oracle_sql()))
"""


@pytest.mark.parametrize("gone", [("waitline/llm", "corpus_pipeline.py"), ("waitline/llm",)])
def test_service_queries_stay(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *[
        Path(g).name for g in gone
    ]))
    ran = subprocess.run(
        [sys.executable, "-c", NAMES], cwd=copy, capture_output=True, text=True, timeout=300
    )
    assert ran.returncode == 0, ran.stderr
    names, with_sql = (part.split() for part in ran.stdout.split("|"))
    assert names == with_sql == sorted(oracles.oracle_sql())
