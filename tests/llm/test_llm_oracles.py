from __future__ import annotations

import pytest

from larkspur.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL, assert_same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SMALL).toPandas(), duck.sql(ORACLES[name]).df())


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
