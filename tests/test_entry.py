"""The entry module without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_the_training_data_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", ".hypothesis"))
    assert (copy / "__spark_entry__.py").exists() and not (copy / "asofspark" / "llm").exists()
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and set(e.oracle_sql()) <= set(q) and len(q) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
