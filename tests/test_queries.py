import pytest

from sparrowmill.plans import catalog

from .oracle import SMALL, assert_same

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, SMALL)
    if name in SQL:
        assert_same(df, SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
