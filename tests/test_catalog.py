"""Every registered query against its SQL on the smallest test tables."""

import os
import pathlib
import re
import sys

import pytest
from conftest import ROOT

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
import verify  # noqa: E402
from catalog import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return verify.connect(SF_DIR)


def test_contract(spark):
    without_sql = set(contract.queries()) - set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert without_sql & set(QUERIES) == {"tree_distance"}
    # What SQL cannot express is named in a test of its own.
    texts = "".join(p.read_text() for p in pathlib.Path(ROOT, "tests").rglob("test_*.py"))
    assert [name for name in sorted(without_sql) if not re.search(rf"\b{name}\b", texts)] == []
    assert contract.entry(spark).count() == 16


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert verify.difference(spark, duck, SF_DIR, name) is None
