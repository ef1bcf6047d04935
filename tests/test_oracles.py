"""Every query against its SQL on the smallest tables; those without SQL must run and have rows."""

from __future__ import annotations

import pytest

from larkspur.plans.catalogue import ORACLES, QUERIES
from tests.conftest import SMALL, assert_same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SMALL).toPandas(), duck.sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
