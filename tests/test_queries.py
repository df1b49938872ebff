"""Every registered query runs, and equals its SQL where it has one."""

import pytest
from compare import DATA, assert_same

from dispensa.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, DATA).toPandas()
    assert len(found)
    if name in ORACLES:
        assert_same(found, ORACLES[name])


def test_entry_imports():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
