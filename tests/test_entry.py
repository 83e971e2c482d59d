"""The entry module without the training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'))"


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_corpus_operators(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT / "tickerloom", tmp_path / "tickerloom", ignore=left_out)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline:
        (tmp_path / "corpus_pipeline.py").write_text("import tickerloom.llm.bpe")
    (tmp_path / "tickerloom" / "llm" / "__pycache__").mkdir(parents=True)
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    count, checks, names = run.stdout.strip().split(" ", 2)
    assert int(count) > 140 and int(checks) > 140 and names == "[]"
