"""Every registered query of the core against its SQL."""

import pytest
from compare import same

from millrace import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(name, spark, duck, sf_dir):
    same(catalog.QUERIES[name](spark, sf_dir), duck, catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(name, spark, sf_dir):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert 0 < __spark_entry__.entry(spark).count() <= 12
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
