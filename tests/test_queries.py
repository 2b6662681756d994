"""Every registered query against its DuckDB twin; the others return rows."""

import pytest
from twins import same_rows

from loomsift.plans.catalogue import ORACLES, QUERIES
from loomsift.plans.gate_queries import SLOW


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(name, spark, sf_dir, duck):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(SLOW))
def test_slow_twin(name, spark, sf_dir, duck):
    same_rows(QUERIES[name](spark, sf_dir), duck, SLOW[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - set(SLOW)))
def test_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
