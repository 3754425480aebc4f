"""Every registered linkage query against its SQL on the same tables."""

import pytest

from korvane.plans import queries as _  # noqa: F401
from korvane.plans import registry
from tests.compare import rows


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, sf, duck, name):
    got, want = registry.QUERIES[name](spark, sf).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
