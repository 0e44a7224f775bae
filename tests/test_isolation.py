"""The library without its optional parts: a copy that lacks them still registers and imports everything else."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [["entitylake/llm"], ["entitylake/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    absent = {str(REPO / g) for g in gone}

    def skipped(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in absent]

    shutil.copytree(REPO, copy, ignore=skipped)
    code = (
        "import __spark_entry__ as e; q, o = set(e.queries()), set(e.oracle_sql()); "
        "assert set(e.library_queries()) <= q and set(e.library_oracle_sql()) <= o <= q; "
        "print(sum(n.startswith('op') or n == 'pipeline' for n in q))"
    )
    env = os.environ | {"PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-2000:]
    if "entitylake/llm" in gone:
        assert run.stdout.split() == ["0"]
