import pytest
import chunkmill.document_queries  # noqa: F401  adds its queries to the catalogue
from chunkmill.queries import ORACLE_SQL, QUERIES
from oracle import SF, same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_oracle(spark, name):
    same(QUERIES[name](spark, SF), ORACLE_SQL[name])


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
