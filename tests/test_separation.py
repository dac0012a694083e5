"""The library without the subpackage for training data."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), sum(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q))"


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_entry_without_training_operators(tmp_path, pipeline_too):
    for name in ("gridloom", "__spark_entry__.py", "corpus_pipeline.py"):
        full = os.path.join(TOP, name)
        if os.path.isdir(full):
            shutil.copytree(full, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif os.path.exists(full):
            shutil.copy(full, tmp_path / name)
    shutil.rmtree(tmp_path / "gridloom" / "llm", ignore_errors=True)
    if pipeline_too:
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    n, ours = map(int, got.stdout.split())
    assert n > 80 and ours == 0
