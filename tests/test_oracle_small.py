"""A sample of registered queries against their DuckDB oracle at sf0.001."""
import datetime as dt
import math
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
KEYS = ["weekly_segment_sales", "demand_features", "store_product_pairs", "variant_weight_map", "safety_stock_weighted",
        "breakdown_to_store", "weekly_to_daily", "replenishment_need_prod", "warehouse_distribution", "future_features", "replenishment_need_local", "replenishment_need_fused", "weekly_segment_sales_local",
        "land_raw_text", "edge_rename", "publish_distribution", "seasonal_months"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 4):.4f}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["nation", "supplier", "part", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_quantity" in df.columns
