"""Every query with SQL agrees with DuckDB; the others give rows of a stable schema."""

import pytest
from compare import DATA, differences

from chronoloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    assert differences(spark, f"{DATA}/sf0.01", registry.QUERIES[name], registry.ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_gives_rows(spark, name):
    df = registry.QUERIES[name](spark, f"{DATA}/sf0.001")
    assert len(df.columns) == len(set(df.columns)) and df.count() >= 0


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
