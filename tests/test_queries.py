"""Every registered query of the library against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from rankloom.plans.oracle import ORACLE  # noqa: E402
from rankloom.plans.queries import QUERIES  # noqa: E402
from tools.compare import compare  # noqa: E402


def test_contract(spark):
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[0] == "full_name"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, name):
    outcome = compare(spark, folder, name)
    assert outcome.startswith("ok") and "types" not in outcome, outcome
