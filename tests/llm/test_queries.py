import os

import pytest

from forgelake.llm import catalogue
from tests.oracle import DATA, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    if name in catalogue.SQL:
        compare(spark, catalogue.QUERIES[name], catalogue.SQL[name])
    else:
        assert catalogue.QUERIES[name](spark, DATA).count() >= 0


@pytest.mark.parametrize("name, columns", [("p1_found", ["comment_id", "field_name", "pii_type"]), ("p3_found", ["record_kind", "record_id"]), ("p4_found", ["comment_id"]), ("p8_ids", ["doc_id", "ids"]), ("p10_found", ["doc_id"])])
def test_columns_and_distinct_rows(spark, name, columns):
    df = catalogue.QUERIES[name](spark, DATA)
    assert df.columns == columns
    assert df.count() == df.distinct().count()
