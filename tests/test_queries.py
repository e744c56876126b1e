"""Every core query against its SQL, over whole tables."""

import pytest
from comparing import compare, connection

from edicta.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert name in catalog.ORACLE
    assert compare(df, con, catalog.ORACLE[name]) == ""
