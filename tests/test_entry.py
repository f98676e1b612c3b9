"""The entry without the optional subpackage: every other query stays."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E

from conftest import ROOT


def test_entry_stands_without_the_optional_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/colloquy", tmp_path / "colloquy", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    own = [n for n in E.queries() if n != "pipeline" and not n.startswith("op")]
    assert done.stdout.split() == [str(len(own))] * 2
