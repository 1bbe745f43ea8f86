"""The entry without the training-data part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'feed_to_table' in q and set(s) <= set(q); print(len(q), any(n.startswith('op') for n in q))"


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py"), ("llm but its folder",)])
def test_entry_without_the_training_data_part(tmp_path, gone):
    skip = shutil.ignore_patterns(".git", "__pycache__", *([] if "but" in gone[0] else gone))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    if "but" in gone[0] and (tmp_path / "repo" / "tidegate" / "llm").exists():
        for file in (tmp_path / "repo" / "tidegate" / "llm").iterdir():
            if file.is_file():
                file.unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split()[-1] == "False"
