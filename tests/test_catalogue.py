"""Every catalogued query runs, and equals its SQL in DuckDB where there is one."""

import duckdb
import pandas as pd
import pytest

from spanloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return None
        if isinstance(v, pd.Timestamp):
            return str(v.tz_localize(None))
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(str(cell(v)) for v in row) for row in df.itertuples(index=False))


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, sf_dir, duck, name):
    got = catalogue.queries()[name](spark, sf_dir).toPandas()
    if sql := catalogue.oracle_sql().get(name):
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)
    else:
        assert len(got.columns)
