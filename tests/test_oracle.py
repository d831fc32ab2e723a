import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from conftest import SMALL
from loglathe.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry_without_the_optional_part(tmp_path):
    """The entry module of a tree without the training-data operators has the library's own queries."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "loglathe", tmp_path / "loglathe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for pipeline in (True, False):
        for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline and (root / "corpus_pipeline.py").exists() else [])):
            shutil.copy(root / name, tmp_path)
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin"})
        assert ran.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry(spark):
    assert entry(spark).count() == 969


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    same, note = compare(spark, con, name, SMALL)
    assert same, note
