import pytest

from vectorloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_sql(name, same):
    same(catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["i", "j", "cos"]
