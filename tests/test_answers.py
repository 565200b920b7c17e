"""Every registered answer against independently written SQL, and what its plan must not contain."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
# The training-data queries have tests of their own and may be absent.
EXTRA = re.compile("op[0-9]+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not EXTRA.match(n)}
SQL = {n: s for n, s in entry.oracle_sql().items() if not EXTRA.match(n)}
# Nested-loop and Cartesian joins pair all rows; Python nodes leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_answer_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_answer(spark, db, name):
    answer = QUERIES[name](spark, FOLDER)
    assert differences(answer, db, SQL[name]) is None
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in UNWANTED if n in plan]


def test_entry(spark):
    assert entry.entry(spark).count() == 200
