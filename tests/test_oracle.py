"""Every registered query against its SQL, on the test tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.01"
# The corpus operators have tests of their own, where they are present.
QUERIES = registry.event_queries()
ORACLE = {name: registry.oracle_sql()[name] for name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(str(value) for value in row) for row in frame.itertuples(index=False))


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= registry.oracle_sql().keys()
    assert QUERIES.keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    for column in ours.columns:
        if str(theirs[column].dtype).startswith("datetime"):
            ours[column] = pd.to_datetime(ours[column]).astype("datetime64[us]")
            theirs[column] = theirs[column].astype("datetime64[us]")
    assert len(ours) > 0
    assert canonical(ours) == canonical(theirs)


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
