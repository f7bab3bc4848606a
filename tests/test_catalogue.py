import pytest
from conftest import same_rows

from millrace.plans import catalogue


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_its_sql(spark, duck, sf, name):
    same_rows(catalogue.QUERIES[name](spark, sf), duck, catalogue.ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
