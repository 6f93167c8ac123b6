"""Every query with SQL agrees with DuckDB on the whole tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests import oracle


@pytest.fixture(scope="module")
def connection(data_dir):
    return oracle.connect(data_dir)


def test_listing_queries_needs_no_session():
    listing = "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 0)"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    said = subprocess.run([sys.executable, "-c", listing], cwd=root, capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "True"


@pytest.mark.parametrize("left_out", [("farekit/llm",), ("corpus_pipeline.py",), ("farekit/llm", "corpus_pipeline.py")])
def test_loads_without_the_training_data_part(tmp_path, left_out):
    """Listing queries and collecting the tests must work with those folders gone, pipeline file or not."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    names = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse", ".hypothesis")
    gone = {os.path.join(root, path) for path in (*left_out, "tests/llm")}
    shutil.copytree(root, copy, ignore=lambda at, found: names(at, found) | {f for f in found if os.path.join(at, f) in gone})
    listing = "import __spark_entry__ as e; print(*e.queries()); e.oracle_sql()"
    said = subprocess.run([sys.executable, "-c", listing], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert "pipeline" not in said and "s01_typed_scan" in said
    there = os.path.exists(os.path.join(root, "farekit", "llm", "queries.py")) and "farekit/llm" not in left_out
    assert any(name.startswith("op1_") for name in said) == there
    subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q"], cwd=copy, capture_output=True, check=True)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, data_dir, connection, name):
    assert oracle.compare(entry.queries()[name](spark, data_dir), connection, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, data_dir, name):
    assert entry.queries()[name](spark, data_dir).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_the_pipeline_of_another_copy_does_not_count(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "farekit"), copy / "farekit", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    listing = "import __spark_entry__ as e; print(*e.queries())"
    env = {**os.environ, "PYTHONPATH": root}
    said = subprocess.run([sys.executable, "-c", listing], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert "pipeline" not in said and "s01_typed_scan" in said
