import os

import pytest

from forgelake.plans import catalogue
from tests.oracle import DATA, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, name):
    compare(spark, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs_without_sql(spark, name):
    df = catalogue.QUERIES[name](spark, DATA)
    assert df.columns
    df.collect()


def test_entry(spark):
    assert catalogue.flagship(spark, DATA).count() > 0


def test_sql_has_queries():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
