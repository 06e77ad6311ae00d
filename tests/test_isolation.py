"""The package without its training-data folder: the other queries are all there."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

SHOW = """
import __spark_entry__ as e
from tidemark.plans.queries import ORACLES, QUERIES
assert set(e.queries()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
assert set(e.oracle_sql()) == set(ORACLES)
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_other_queries_need_no_training_data_folder(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=left_out)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
