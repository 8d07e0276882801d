"""Every registered query that is not of the corpus part against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, engine, types_differ

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return engine(SF)


def test_every_query_has_a_twin():
    assert set(entry.CORE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.CORE))
def test_twin(spark, con, name):
    frame, twin = entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name])
    assert types_differ(frame, twin) is None
    assert compare(frame.toPandas(), twin.df()) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 9
