"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import duckdb
import pytest

from treeline.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = ", ".join(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, duck.sql(f"select {order} from ({catalog.SQL[name]})").fetchall()))
