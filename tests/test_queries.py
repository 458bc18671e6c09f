"""Every registered query of the library itself against its SQL."""

import pytest

from estatelake.plans import listing_queries, registry, run_queries  # noqa: F401
from tests.conftest import SMALL, duck, same_rows


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    same_rows(registry.QUERIES[name](spark, SMALL), con, registry.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
