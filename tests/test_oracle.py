"""Every query against the SQL it must equal, on the smallest data."""

import glob
import os

import duckdb
import pytest

from readflow.plans import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), [str(t) for t in frame.dtypes], sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    result = QUERIES[name](spark, sf).toPandas()
    assert len(result) > 0
    if name in ORACLES:
        assert rows(result) == rows(duck.sql(ORACLES[name]).df())


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"tfidf_hashed", "als_recommend"}
