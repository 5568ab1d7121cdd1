"""Every registered query against its SQL."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from oracle import connect, differences

from shelfpulse.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    problem = differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as contract

    result = contract.entry(spark)
    assert result.columns == ["appid", "dt", "gmv", "add_review_num"]
    assert result.count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as contract
print(len(contract.queries()))
"""


def _hiding(*names):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = HIDE.format(names=names)
    return subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)


def test_only_the_absence_of_the_corpus_part_is_passed_over():
    for names in (("shelfpulse.llm",), ("corpus_pipeline", "shelfpulse.llm")):
        done = _hiding(*names)
        assert done.returncode == 0 and int(done.stdout.split()[-1]) == len(QUERIES)
    pytest.importorskip("shelfpulse.llm", exc_type=ImportError)
    assert _hiding("numpy").returncode != 0
