import pytest

from larkspur.plans import catalog
from tests.oracle import duck, same


#: Queries whose answer may have no rows on the smallest tables, and why.
MAY_BE_EMPTY: dict[str, str] = {}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLE_SQL:
        same(con, df, catalog.ORACLE_SQL[name])
    assert name in MAY_BE_EMPTY or not df.isEmpty()  # nothing equals nothing
