"""Every core query against its SQL, and those without SQL for their rows."""

import pytest
from oracle import compare

from corpusloom.plans import registry

QUERIES = registry.load()


def test_registry_and_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(registry.ORACLE)))
def test_sql(spark, sf, duck, name):
    assert compare(QUERIES[name](spark, sf), duck, registry.ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(registry.ORACLE)))
def test_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
