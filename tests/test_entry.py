"""The entry module must work without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "build_dataset" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(entry.oracle_sql()) <= names
"""


def test_imports_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm"))
    for left_out in ([], ["corpus_pipeline.py"]):
        for name in left_out:
            (copy / name).unlink()
        env = {**os.environ, "PYTHONPATH": os.environ.get("PYTHONPATH", "")}
        subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, check=True)
        tests = [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"]
        assert subprocess.run(tests, cwd=copy, env=env, stdout=subprocess.DEVNULL).returncode == 0
