"""Registered queries against their SQL at the smallest scale, and plan checks."""

import duckdb
import pandas as pd
import pytest

from promolens.plans import all_queries
from promolens.plans.mart import open_mart

SF = "/root/testdata/sf0.001"
PICKED = ["d02_sku", "d05_promotional_to_sku", "d07_transaction_to_sku", "d12_root_sku", "d19_daily_transaction_to_sku", "d23_std_price_margin",
          "d30_promo_summary", "d38_recursive_counterfactual", "d40_counterfactual_promo", "d44_pareto_promo_table", "d50_cannibal_attribution", "d53_smoothed_history",
          "d59_sku_elasticity", "d71_post_promo_profile_excluded", "d77_scoring_table", "a15_median", "w06_percent_rank", "w10_stepwise_carry", "s02_header_detection"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain_rows(frame):
    cols = sorted(frame.columns)
    rows = []
    for rec in frame[cols].itertuples(index=False, name=None):
        rows.append(tuple(None if pd.isna(v) else str(v)[:10] if hasattr(v, "year") else v if isinstance(v, (str, bool)) else float(v) for v in rec))
    return cols, sorted(rows, key=repr)


@pytest.mark.parametrize("name", PICKED)
def test_query_equals_sql(spark, duck, name):
    query = all_queries()[name]
    assert plain_rows(query.run(spark, SF).toPandas()) == plain_rows(duck.execute(query.sql).df())


def test_registry_is_complete():
    queries = all_queries()
    assert len(queries) > 170 and sum(q.sql is None for q in queries.values()) <= 11
    for i in range(1, 95):
        assert any(name.startswith(f"d{i:02d}_") for name in queries), i


def test_scan_is_pruned_and_nothing_is_a_cross_join(spark):
    mart = open_mart(spark, SF)
    df = mart["weekly"].where("promo_flag = 0").select("sku_root_id", "total_sale_qty")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(promo_flag), EqualTo(promo_flag,0)]" in plan and "ReadSchema: struct<sku_root_id:string,total_sale_qty" in plan
    for name in ("grid", "filled", "promo_daily_total", "post_promo", "score", "cannibalisation"):
        text = mart._recipes[name]()._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
