"""Rows that come placed by product stay so through the joins and sums that read them by product."""

import re

import pytest
from pyspark.sql import functions as F

from promolens.operators import dims, sales
from promolens.plans.mart import open_mart
from promolens.session import Workspace, joins_in_place
from promolens.sources import retail_adapter

SF = "/root/testdata/sf0.001"


@pytest.fixture
def unbroadcast(spark):
    """No side of a join is broadcast unless a hint says so."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_kept_tables_stay_placed(spark, unbroadcast):
    rows = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"), (F.col("id") % 7).alias("n"), "id")
    kept = Workspace(spark).keep(rows.repartition("k"), "rows", placed_by=["k"])
    assert kept.columns == rows.columns and same_rows(kept, rows)
    other = rows.select("k", "n").distinct().repartition("k")
    assert exchanges(kept.groupBy("n", "k").count()) == []
    joined = kept.join(other, ["n", "k"])
    assert len([k for k in exchanges(joined) if k == "n, k"]) == 2 and joined.count() == 1000
    with joins_in_place(spark):
        joined = kept.join(other, ["n", "k"])
        assert "n, k" not in exchanges(joined) and joined.count() == 1000


def test_lines_meet_their_offers_where_they_are(spark, unbroadcast):
    mart = open_mart(spark, SF)
    lines, skus, offers = mart.raw["lines"], mart["sku"], mart["promo_to_sku"]
    stores, days = F.broadcast(mart["store"]), F.broadcast(mart["calendar"])
    with joins_in_place(spark):
        found = sales.lin_transaction(lines, stores, days, skus, offers, in_place=True)
        keys = exchanges(sales.transaction_to_sku(found))
        assert not any("_code" in k or "promo_id" in k or "transaction_id" in k for k in keys)
        assert keys.count("COD_ART") == 2 and keys.count("sku_root_id, store_id, date") == 1  # lines and parts, then lines
        got = found.collect()
    assert same_rows(spark.createDataFrame(got, found.schema), sales.lin_transaction(lines, stores, days, skus, offers))
    assert any(r.promo_id for r in got) and not all(r.promo_id for r in got)


def test_vendor_funding_places_tickets_and_redemptions_alone(spark, unbroadcast):
    mart = open_mart(spark, SF)
    args = mart["trans"], mart.raw["redemptions"], mart["promo_to_sku"], F.broadcast(mart["campaign_days"])
    with joins_in_place(spark):
        found = dims.vendor_funding(*args)
        keys = exchanges(found)
        assert keys.count("sku_id") == 1 and not any("promo_id" in k or "store_id" in k for k in keys)
        got = found.collect()
    assert got and same_rows(spark.createDataFrame(got, found.schema), dims.vendor_funding(*args))


def test_days_of_lines_are_those_of_the_lines(spark):
    tables = retail_adapter.read_tables(spark, SF)
    days = retail_adapter.line_days(tables)
    assert same_rows(days, retail_adapter.lines(tables).select("DIA"))
    assert not any("COD_ART" in k for k in exchanges(days))


def test_orders_are_met_before_products_widen_the_lines(spark, unbroadcast):
    keys = exchanges(retail_adapter.lines(retail_adapter.read_tables(spark, SF)))
    assert keys.count("l_orderkey") == 1 and keys.count("COD_ART") == 2 and not any("l_partkey" in k for k in keys)
    assert exchanges(retail_adapter.offers(retail_adapter.read_tables(spark, SF))).count("COD_ART") == 2
