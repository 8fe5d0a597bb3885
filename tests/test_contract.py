"""The driver contract and every registered query against its DuckDB twin."""

import importlib.util
import os

import pytest

from conftest import ROOT, SF001
from oracle_compare import compare, duck

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

NAMES = sorted(entry_mod.QUERIES)  # the corpus operators are tested in tests/llm


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "visits" in df.columns and "paid" in df.columns


def test_every_query_has_sql_twin():
    assert set(NAMES) <= set(entry_mod.oracle_sql())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    rows, problems = compare(spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF001)
    assert not problems, problems
