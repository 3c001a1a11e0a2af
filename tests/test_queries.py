"""Every listed query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import differences, duckdb_tables

import __spark_entry__ as entry
from eventpulse.catalogue import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    problems, _, _ = differences(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert problems == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_optional_part(tmp_path):
    root = Path(entry.__file__).resolve().parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "eventpulse", tmp_path / "eventpulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    told = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, capture_output=True, text=True, env={"PATH": os.environ["PATH"]})
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr
