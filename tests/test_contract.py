"""The driver contract, with and without the training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q))"


def names(folder) -> list[str]:
    out = subprocess.run([sys.executable, "-c", ASK], cwd=folder, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("gone", [["cogwright/llm"], ["corpus_pipeline.py"], ["cogwright/llm", "corpus_pipeline.py"]])
def test_training_data_part_removed(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.txt"))
    for g in gone:
        shutil.rmtree(copy / g) if (copy / g).is_dir() else (copy / g).unlink(missing_ok=True)
    n, optional = names(copy)
    assert int(n) > 50 and optional == str("cogwright/llm" not in gone and (copy / "cogwright" / "llm").exists())
