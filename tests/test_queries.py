"""Every registered query against its SQL."""

import pytest
from compare import compare, oracle_connection
from conftest import SMALL

from landfall.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SMALL)
    if name in ORACLE:
        assert compare(frame, con, ORACLE[name]) is None
    else:
        assert not frame.isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
