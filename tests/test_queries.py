"""Every registered query against its SQL counterpart, and the contract around them."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from oracle_compare import connect, difference

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_every_sql_text_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [("barlake/llm", "tests/llm"), ("barlake/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_works_without_the_training_data_operators(tmp_path, gone):
    here = os.path.dirname(os.path.abspath(contract.__file__))
    left_out = [os.path.join(here, path) for path in gone]
    leave = lambda folder, names: [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in left_out]
    shutil.copytree(here, tmp_path / "copy", ignore=leave)
    code = "import __spark_entry__ as c; print(*sorted(c.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == sorted(QUERIES)
