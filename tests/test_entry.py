import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

HERE = Path(__file__).resolve().parents[1]


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(f) for f in entry.queries().values())


@pytest.mark.parametrize("gone", [["siftlode/llm"], ["siftlode/llm", "corpus_pipeline.py"]])
def test_the_rest_stands_without_the_corpus_operators(tmp_path, gone):
    """The other queries are registered from a copy of the checkout that lacks them."""
    shutil.copytree(HERE, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *(Path(g).name for g in gone)))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", check=True, timeout=120)
