"""Every query of the catalogue gives DuckDB's rows for its SQL."""

import os

import duckdb
import pandas as pd
import pytest

from mizan.plans import catalogue

from .conftest import SF


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return c


def rows(frame, columns):
    clean = lambda v: None if pd.isna(v) else int(v) if not isinstance(v, (str, bytes)) and float(v).is_integer() else v
    return sorted(repr(tuple(clean(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_same_rows(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.ORACLES:
        assert len(got)
        return
    want = db.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
    assert len(got)


def test_no_oracle_without_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
