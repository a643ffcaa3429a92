import pytest

from tarn import queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_gives_the_oracles_rows(name, spark, sf_dir, oracle):
    oracle.same(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name])


def test_entry_has_every_query(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
