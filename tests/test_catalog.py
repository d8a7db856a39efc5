import pytest

import __spark_entry__ as entry
from cairnstat.plans import catalog

from .compare import same


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    same(catalog.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(catalog.ORACLE_SQL[name]).df())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_entry_lists_all_queries():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
