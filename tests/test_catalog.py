"""Every query against its SQL in DuckDB, on whole tables."""

import pytest

from loomspan import catalog
from tests.oracle import compare

ORACLE = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    compare(spark, sf_dir, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
