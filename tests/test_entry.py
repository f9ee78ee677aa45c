"""The entry works in a copy of the repository without the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); print(len(q)); print(*sorted(q)); assert set(o) <= set(q)"


def _names(folder, *left_out):
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *left_out))
    env = {**os.environ, "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split("\n")[1].split())


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_without_the_text_folders(tmp_path, left_out):
    names = _names(tmp_path / "copy", *left_out)
    assert "market_silver" in names
    assert "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    shown = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests", "--deselect", "tests/test_entry.py"],
        cwd=tmp_path / "copy", capture_output=True, text=True, timeout=180,
    )
    assert shown.returncode == 0, shown.stdout + shown.stderr
