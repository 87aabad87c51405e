"""The entry works without the training-data folders, whatever lies on the path."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); print(len(q), len(o), any(n.startswith('op') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("polluted", [False, True], ids=["clean path", "repository on the path"])
@pytest.mark.parametrize("pipeline", [False, True], ids=["pipeline deleted", "pipeline left"])
def test_entry_without_llm(tmp_path, pipeline, polluted):
    shutil.copytree(REPO / "medallion", tmp_path / "medallion", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists() and (pipeline or name != "corpus_pipeline.py"):
            shutil.copy(REPO / name, tmp_path / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if polluted:
        env["PYTHONPATH"] = str(REPO)
    said = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    queries, oracles, llm = said.stdout.split()
    assert int(queries) >= 60 and int(oracles) >= 60 and llm == "False"
