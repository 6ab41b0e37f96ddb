"""Every corpus query that has SQL equals it on the smallest tables."""

import pytest

from checks.compare import connect, oracle_rows, spark_rows
from tests.llm.helpers import SF
from wardstat.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    with connect(SF) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, connection, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(connection, ORACLES[name])
