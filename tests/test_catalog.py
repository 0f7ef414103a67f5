"""Every query of the engine's own catalog against its SQL on the given tables."""

import pytest

from smoothway.plans import catalog
from tests.compare import assert_same


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_oracle(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLES:
        assert_same(df, duck, catalog.ORACLES[name])
    else:
        assert df.columns and df.count() >= 0


def test_names_of_the_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
