"""Every query with SQL, against DuckDB on the smallest tables; the others run."""

import math
import os

import duckdb
import pandas as pd
import pytest

from tidewright import queries as q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def cells(df, columns):
    def one(c, v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return "-"
        return str(v)[:10] if "date" in c or c.endswith("_day") or c.startswith(("train_", "test_")) else repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "fi" else str(v)

    return sorted(tuple(one(c, v) for c, v in zip(columns, r)) for r in df[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    got, want = q.QUERIES[name](spark, SF).toPandas(), db.execute(q.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert cells(got, columns) == cells(want, columns)


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_query_gives_finite_rows(spark, name):
    rows = q.QUERIES[name](spark, SF).collect()
    assert rows and all("prediction" not in r or r["prediction"] >= 0 for r in map(lambda r: r.asDict(), rows))
