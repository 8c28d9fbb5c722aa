"""The driver's entry points, with and without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q if not n.startswith('orphans')), set(o) <= set(q))"


def shown(folder: Path) -> list[str]:
    run = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_entry_returns_the_flagship_query(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() == 25 and df.columns == ["territory_id", "territory_name", "revenue", "line_items"]


@pytest.mark.parametrize("deleted", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_works_without_the_corpus_operators(tmp_path, deleted):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *deleted))
    n, extra, fine = shown(copy)
    assert int(n) > 60 and extra == "0" and fine == "True"


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "tidewell").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tidewell.llm" not in path.read_text(), path


def test_all_operators_are_registered():
    if not (ROOT / "tidewell" / "llm").exists():
        pytest.skip("without the corpus operators")
    _, extra, fine = shown(ROOT)
    assert extra == "14" and fine == "True"  # thirteen operators and the pipeline
