"""Every registered query against its SQL on the smallest tables, and what its plan must not hold."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gleanery.checks import ORACLES, QUERIES
from check import TYPES, as_bag, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert {c[0]: TYPES.get(str(c[1])) for c in cursor.description} == dict(df.dtypes)
    assert as_bag(df.columns, [tuple(r) for r in df.collect()]) == as_bag(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()
