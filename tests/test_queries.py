"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys
import tempfile

import pytest

import __spark_entry__ as entry_module
from tests.conftest import SMALL
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 43


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_queries_without_sql_have_tests_of_their_own():
    """Only text operators whose models SQL cannot express, each compared otherwise in ``tests/llm``."""
    rest = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert all(n.startswith("op") or n == "pipeline" for n in rest)


def test_entry_without_the_text_operators():
    """Whatever keeps the optional subpackage from being imported, the other queries are there."""
    code = """
import sys
sys.modules['zonewise.llm.queries'] = None
import __spark_entry__ as e
names = set(e.queries())
assert 'b10_breaches' in names and not any(n.startswith('op') for n in names), names
"""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env={**os.environ, "PYTHONPATH": root}, timeout=120)


def test_a_session_without_a_checkpoint_folder():
    """The folder is set nowhere: the library takes one of its own and sets no setting that Spark refuses."""
    code = """
from zonewise.session import local_session, materialize, shared_dir
spark = local_session(cores=1)
assert spark.conf.get('spark.checkpoint.dir', None) is None
assert shared_dir(spark) == shared_dir(spark)
assert materialize(spark.range(3)).count() == 3
"""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    env = {**os.environ, "PYTHONPATH": root, "SPARK_CONF_DIR": tempfile.mkdtemp(prefix="conf-", dir="/tmp")}
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=env, timeout=120)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SMALL, name)
    assert ok, text
