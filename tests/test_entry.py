"""The entry file without the subpackage for training text."""

from __future__ import annotations

import pathlib
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from fixtures import registered

ROOT = pathlib.Path(entry.__file__).parent
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_import_without_the_llm_folders(tmp_path, with_pipeline):
    left_out = {"llm", "__pycache__", ".git"} | (set() if with_pipeline else {"corpus_pipeline.py"})
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: left_out & set(names))
    assert not (copy / "inkwell/llm").exists() and not (copy / "tests/llm").exists()
    run = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True, check=True)
    queries, sql = (line.split() for line in run.stdout.splitlines())
    assert queries == sorted(registered.queries())
    assert sql == queries
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, capture_output=True, text=True
    )
    assert collected.returncode == 0, collected.stdout[-2000:]
