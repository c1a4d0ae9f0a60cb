"""The entry point on a copy of the repository without the operators for training text."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_llm(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e, tests.test_queries, tests.oracle, bench; assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
