"""Every series query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from seriesloom import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)

    def plain(x):
        if x is None or isinstance(x, (bool, str)):
            return x
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted((tuple(plain(x) for x in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_same_rows_as_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF).toPandas()
    want = duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
