"""Every registered query equals its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracles import connect, differences

SF_DIR = contract.SMOKE_DIR
NAMES = sorted(contract.queries())


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


WITH_SQL = sorted(contract.oracle_sql())


def test_only_training_data_queries_lack_an_oracle():
    assert set(WITH_SQL) <= set(NAMES)
    assert all(n == "pipeline" or n.startswith("op") for n in set(NAMES) - set(WITH_SQL))


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_oracle(spark, sql, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert differences(got, sql.sql(contract.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "sensor_id"
