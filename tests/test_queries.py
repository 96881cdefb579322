"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as contract
from helpers import plan_of
from workload.adapter import Supplied
from workload.check import compare, connect
from workload.registry import CASES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def supplied(spark):
    return Supplied(spark, FOLDER)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("case", CASES, ids=lambda c: c.name)
def test_query(case, supplied, con):
    assert compare(case, supplied, con) is None
    plan = plan_of(case.run(supplied), "simple") if not case.name.startswith(("stream", "mv_", "csv")) else ""
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {c.name for c in CASES} <= set(contract.queries())
    assert len(CASES) == len({c.name for c in CASES})
    assert contract.entry(spark).count() > 0
