from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SHOWN = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def shown(folder: Path) -> list[str]:
    return subprocess.run([sys.executable, "-c", SHOWN], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_queries_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    shutil.rmtree(copy / "graftline" / "llm", ignore_errors=True)
    without = shown(copy)
    assert without[2] == "False" and int(without[0]) >= 58
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert shown(copy) == without
