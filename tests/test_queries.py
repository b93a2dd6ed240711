"""Each registered query against its SQL; those without SQL must run and give rows."""

import pytest
from compare import duck_rows, spark_rows
from conftest import SF

from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    columns, rows = spark_rows(registry.queries()[name](spark, SF))
    if name in registry.oracle_sql():
        wanted_columns, wanted = duck_rows(registry.oracle_sql()[name], SF)
        assert columns == wanted_columns
        assert rows == wanted
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
