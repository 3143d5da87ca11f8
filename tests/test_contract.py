"""Every registered query against its oracle."""

import pytest

import __spark_entry__ as entry_point
from contract.catalogue import ORACLES
from contract.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, oracle, name):
    result = entry_point.queries()[name](spark, SF)
    assert differences(result, oracle, ORACLES[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
