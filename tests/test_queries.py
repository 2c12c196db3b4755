"""Every registered query against its SQL, over the driver tables at the smallest scale."""

import pytest

import __spark_entry__ as entry
from verification.compare import compare, connect
from verification.queries import CASES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", list(CASES))
def test_query_agrees_with_sql(spark, database, name):
    assert compare(spark, database, name, SF) is None


def test_driver_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.columns == ["agent_name", "total_tickets", "agent_mttr", "agent_fcr_rate",
                                "agent_sla_compliance", "sla_colour"]
    assert flagship.count() > 0
