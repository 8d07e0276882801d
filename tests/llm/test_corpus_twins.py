"""The corpus queries that SQL can express, against their twins on the smallest tables."""

import pytest

from check import compare, engine, types_differ
from tidelog.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return engine(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, con, name):
    frame, twin = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert types_differ(frame, twin) is None
    assert compare(frame.toPandas(), twin.df()) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_twin_gives_every_document(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    if name != "op11_whitening":
        assert frame.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    else:
        assert frame.select("vec_id").distinct().count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()
