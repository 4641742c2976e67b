"""Every registered query against its SQL on the smallest tables; those without SQL have to run, and are tested elsewhere."""

import pytest
from textloom.plans.registry import ORACLES, QUERIES

from .oracle import SF, same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        same(df, ORACLES[name])
    else:
        df.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
