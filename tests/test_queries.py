"""Each query of the plans against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from evidentia.plans import more  # noqa: F401  registers its queries
from evidentia.plans.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DIR).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    a, b = _norm(got), _norm(duck.sql(ORACLE[name]).df())
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    for c in a.columns:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
