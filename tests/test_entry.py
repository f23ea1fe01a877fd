"""The entry point with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("removed", [("siltbed/llm",), ("siltbed/llm", "corpus_pipeline.py")])
def test_other_queries_stay_without_the_subpackage(tmp_path, removed):
    copy = tmp_path / "repo"
    skip = {str(ROOT / r) for r in removed}
    shutil.copytree(
        ROOT, copy,
        ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__", "tests") or str(Path(at, n)) in skip],
    )
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    found = subprocess.run([sys.executable, "-c", NAMES], cwd=copy, env=env, capture_output=True, text=True, check=True)
    names = found.stdout.split()
    assert "top_languages" in names and "publish_table" in names
    assert not [n for n in names if n.startswith("op") and n[2:3].isdigit() or n == "pipeline"]
