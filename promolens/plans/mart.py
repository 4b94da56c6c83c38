"""The promotion mart: every table by name, built once per session.

A table is declared as a function of other tables. Facts that several tables read
are written to the shared folder on first use; everything else stays a plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    counterfactual, cannibal, dashboards, dims, elasticity, facts, forecast, offers, promo_facts, sales, sparse, training, uplift,
)
from ..session import Workspace, hash_joins, joins_in_place
from ..sources import retail_adapter

# Tables that are read many times and cut long plans.
WRITTEN = {
    "calendar", "campaign", "campaign_days", "periods", "per_day", "per_weekday", "sku", "root_sku", "promo_to_sku", "trans", "vendor_funding", "daily_root_promo", "daily_promo", "daily", "weekly_promo", "weekly", "std_price_margin",
    "offer_rows", "offer_days", "final_offers", "promo_daily_total", "promo_weekly_total", "promo_summary", "counterfactual", "counterfactual_promo", "sku_counterfactual",
    "carrying", "zero_runs", "daily_lined", "promo_lined", "post_lined", "cume", "price_points", "store_lines", "forecast", "train",
}
# Tables made of rows that come placed by product, and the columns by which a kept one stays placed for its readers.
BY_PRODUCT = {"sku": None, "promo_to_sku": ["sku_id"], "trans": None, "vendor_funding": None, "root_sku": None}
MECHANICS = ["10", "20"]


class Mart:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], companies: list[str], own_brand: str, node: int):
        self.spark = spark
        self.raw = raw
        self.companies = companies
        self.own_brand = own_brand
        self.node = node
        self.space = Workspace(spark)
        self._made: dict[str, DataFrame] = {}
        self._recipes: dict[str, Callable[[], DataFrame]] = self._declare()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            df = self._recipes[name]()
            if name in WRITTEN:
                with hash_joins(self.spark), joins_in_place(self.spark) if name in BY_PRODUCT else nullcontext():
                    df = self.space.keep(df, name, placed_by=BY_PRODUCT.get(name))
            self._made[name] = df
        return self._made[name]

    def names(self) -> list[str]:
        return list(self._recipes)

    def _declare(self) -> dict[str, Callable[[], DataFrame]]:
        m, raw = self, self.raw
        day = F.to_date("DIA", "yyyyMMdd")
        return {
            "calendar": lambda: dims.calendar_covering(raw["line_days"], day),
            "sku": lambda: dims.sku(
                raw["articles"], raw["structure"], raw["markers"], raw["own_brands"], raw["net_costs"],
                raw["sales_locations"], m.node, m.own_brand,
            ),
            "store": lambda: dims.store(raw["locations"], m.companies),
            "campaign": lambda: dims.campaign(raw["promos"], m["calendar"]),
            "campaign_days": lambda: dims.campaign_days(m["campaign"], m["calendar"]),
            "promo_to_sku": lambda: offers.promo_to_sku(raw["offers"], m["campaign"], m["sku"], m["store"]),
            "lin": lambda: sales.lin_transaction(
                raw["lines"], m["store"], m["calendar"], m["sku"], m["promo_to_sku"], in_place=True
            ),
            "trans": lambda: sales.transaction_to_sku(m["lin"]),
            "transaction": lambda: sales.transaction(m["trans"], raw["headers"]),
            "promo_days": lambda: dims.promo_days(m["promo_to_sku"], m["campaign_days"]),
            "vendor_funding": lambda: dims.vendor_funding(
                m["trans"], raw["redemptions"], m["promo_to_sku"], m["campaign_days"]
            ),
            "root_sku": lambda: dims.root_sku(m["trans"], m["sku"], m["vendor_funding"]),
            "sku_campaign_dates": lambda: dims.sku_campaign_dates(m["campaign"], m["promo_to_sku"], m["root_sku"]),
            "customer": lambda: dims.customer(raw["customers"], dt.date(2019, 12, 1)),
            "promo_root_days": lambda: facts.promo_root_days(m["promo_to_sku"], m["campaign_days"]),
            "daily_root_promo": lambda: facts.daily_root_promo(
                m["trans"], m["root_sku"], facts.promo_windows(m["promo_to_sku"], m["campaign"])
            ),
            "grid": lambda: facts.dense_grid(m["daily_root_promo"], m["calendar"]),
            "grid_promos": lambda: facts.grid_with_promos(m["grid"], m["promo_root_days"]),
            "filled": lambda: facts.gap_fill(m["grid_promos"], m["daily_root_promo"]),
            "daily_promo": lambda: m["filled"],
            "daily": lambda: facts.daily(m["daily_promo"]),
            "weekly_promo": lambda: facts.weekly_promo(m["daily_promo"]),
            "weekly": lambda: facts.weekly(m["weekly_promo"]),
            "carrying": lambda: sparse.carrying_rows(m["daily_root_promo"], m["promo_root_days"], m["calendar"]),
            "zero_runs": lambda: sparse.zero_runs(m["carrying"], m["calendar"]),
            "sparse_weekly_promo": lambda: sparse.weekly_promo(m["carrying"], m["zero_runs"]),
            "std_price_margin": lambda: facts.std_price_margin(m["trans"], m["daily"], m["root_sku"]),
            "offer_rows": lambda: promo_facts.offer_rows(m["promo_to_sku"], m["store"], m["root_sku"]),
            "offer_days": lambda: promo_facts.offer_days(m["offer_rows"], m["campaign_days"], m["daily"], m["daily_promo"]),
            "promo_daily": lambda: promo_facts.promo_daily(m["offer_rows"], m["offer_days"]),
            "allocated": lambda: promo_facts.allocate(m["promo_daily"]),
            "matched": lambda: promo_facts.matched(m["allocated"]),
            "depths": lambda: promo_facts.depth_summary(m["matched"]),
            "final_offers": lambda: promo_facts.final_offers(m["offer_rows"], m["depths"], m["weekly"], m["campaign"]),
            "promo_daily_total": lambda: promo_facts.promo_daily_total(m["final_offers"], m["offer_days"]),
            "promo_weekly_total": lambda: promo_facts.promo_weekly_total(m["promo_daily_total"]),
            "promo_summary": lambda: promo_facts.promo_summary(
                m["promo_weekly_total"], m["weekly"], m["campaign"], m["store"]
            ),
            "post_promo": lambda: promo_facts.post_promo(
                m["final_offers"], m["offer_days"].where(F.col("n_promo").isNotNull()), m["daily"], m["campaign"]
            ),
            "campaign_detail": lambda: promo_facts.campaign_detail(m["campaign"], m["calendar"]),
            "counterfactual": lambda: counterfactual.promo_counterfactual(m["promo_summary"], m["weekly"], m["root_sku"]),
            "counterfactual_promo": lambda: dashboards.counterfactual_promo(
                m["counterfactual"], m["promo_summary"], m["weekly"], m["std_price_margin"], m["campaign"]
            ),
            "sku_counterfactual": lambda: counterfactual.weekly_sku_counterfactual(m["weekly"], m["root_sku"]),
            "cannibalisation": lambda: cannibal.cannibalisation(m["sku_counterfactual"]),
            "forecast": lambda: forecast.forecast(m["sku_counterfactual"]),
            "forecast_metrics": lambda: forecast.fit_metrics(m["forecast"]),
            "price_points": lambda: elasticity.price_points(m["daily"], m["root_sku"]),
            "unit_cost": lambda: elasticity.unit_cost(m["std_price_margin"], m["sku"]),
            "store_lines": lambda: elasticity.store_regression(m["price_points"], m["unit_cost"]),
            "periods": lambda: uplift.active_period(m["daily"]),
            "per_day": lambda: uplift.avg_per_day(m["daily"], m["periods"]),
            "per_weekday": lambda: uplift.avg_per_weekday(m["daily"], m["periods"]),
            "daily_lined": lambda: uplift.attach(m["daily"], m["per_day"], m["per_weekday"]),
            "promo_lined": lambda: uplift.attach(m["promo_daily_total"], m["per_day"], m["per_weekday"]),
            "post_lined": lambda: uplift.attach(m["post_promo"], m["per_day"], m["per_weekday"]),
            "cume": lambda: uplift.cume_filter(m["promo_lined"]),
            "promo_kept": lambda: uplift.keep_pairs(m["promo_lined"], m["cume"], "n_promo"),
            "post_kept": lambda: uplift.keep_pairs(m["post_lined"], m["cume"], "pf_n_promo"),
            "promo_totals": lambda: uplift.promo_totals(m["promo_kept"], m["campaign"]),
            "train": lambda: training.train_table(m["counterfactual_promo"], m["campaign_detail"], m["root_sku"], MECHANICS),
            "post_train": lambda: training.post_train_table(m["counterfactual_promo"], m["campaign_detail"], m["root_sku"]),
            "score": lambda: training.score_table(m["root_sku"], m["train"], m["weekly"]),
        }


_open: dict[tuple[str, str], Mart] = {}


def open_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart over the order-entry tables of a folder, shared within a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Mart(
            spark, retail_adapter.raw_extracts(spark, sf_dir), retail_adapter.COMPANIES,
            retail_adapter.OWN_BRAND_NAME, retail_adapter.SALES_NODE,
        )
    return _open[key]
