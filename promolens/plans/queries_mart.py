"""Queries over the promotion mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import target_codes
from ..functions.trees import Settings
from ..operators import (
    absorbed, boosting, counterfactual, cannibal, dashboards, elasticity, facts, forecast, models, modes, ols, promo_facts, sparse, training, uplift,
)
from ..operators.sales import MEASURES, OFFER_MEASURES
from ..operators.upkeep import FactStore
from ..session import Workspace
from ..sources.publish import read_published
from ..sources.tables import between_days, write_clustered
from . import oracle_mart as o
from .mart import Mart, open_mart
from .registry import add

D = dt.date


def _d(names) -> str:
    return " ".join(f"{n}:d" for n in names)


def mart(name: str):
    return lambda spark, sf: open_mart(spark, sf)[name]


def on(fn):
    return lambda spark, sf: fn(open_mart(spark, sf))


def totals(df: DataFrame, keys: list, sums: list[str], extra: list = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in sums], *extra)


def totals_sql(src: str, keys: str, sums: list[str], extra: str = "") -> str:
    s = "".join(f", sum({c}) AS {c}" for c in sums)
    names = keys.replace("@week", "")
    return f"SELECT {names}, count(*) AS n_rows{s}{extra} FROM {src} GROUP BY ALL"


# --- dimensions -------------------------------------------------------------

add("d01_calendar", mart("calendar"), "date day week:i year_sem month weekend year:i quarter:i national_holiday_1", """
SELECT date, dayname(date) AS day, week(date) AS week, year(date) || 'SEM' || lpad(week(date)::VARCHAR, 2, '0') AS year_sem,
CASE WHEN month(date) = 9 THEN 'Sept' ELSE strftime(date, '%b') END AS month, dayofweek(date) IN (0, 6) AS weekend,
year(date) AS year, quarter(date) AS quarter, NULL::VARCHAR AS national_holiday_1 FROM c_calendar""")

_SKU = ("sku_id sku_root_id type description area_id area section_id section category_id category subcategory_id subcategory "
        "segment_id segment brand_name own_brand_label own_brand_flag flag_healthy wow_flag innovation_flag tourism_flag local_flag "
        "regional_flag wealthy_range_flag vendor_name cost_per_unit:d sales_loc_code")
add("d02_sku", mart("sku"), _SKU, "c_sku")
add("d03_store", mart("store"), "store_id name store_geography_region store_type1 size_m2:d business_area", "c_store")
add("d04_promotional_campaign", mart("campaign"),
    "promo_id promo_year:i name type start_date end_date class customer_profile_type marketing_type", "c_campaign")
_DISP = " ".join(f"{c}:i" for c in promo_facts.DISPLAY)
add("d05_promotional_to_sku", mart("promo_to_sku"),
    "promo_id promo_year:i sku_id sku_root_id store_id promo_mechanic promo_mechanic_description std_price:d "
    f"discounted_price_promo:d discount_depth_rank:d discount_depth brochure:i {_DISP}", "c_offer")
add("d06_lin_transaction", mart("lin"),
    "transaction_id sku_id sku_root_id store_id customer_id date time promo_id promo_year:i IMP_PVP_TARIFA:d sale_type "
    "total_sale_amt:d total_sale_qty:d total_margin_amt:d total_non_oferta_discount_amt:d total_non_oferta_discount_amt_ex_vale:d",
    "c_lintype")
add("d07_transaction_to_sku", mart("trans"),
    f"transaction_id sku_id sku_root_id store_id promo_id promo_year:i customer_id sale_type date time std_price_per_unit:d {_d(MEASURES)}",
    "c_trans")
_T8 = ["total_sale_amt", "total_non_oferta_discount_amt", "total_non_oferta_discount_amt_ex_vale", "total_price_if_sku_std_price", *OFFER_MEASURES]
add("d08_transaction", mart("transaction"),
    f"transaction_id store_id date time type customer_id {_d(_T8)} total_sale_sku_qty:d total_margin:d",
    f"""SELECT t.transaction_id, t.store_id, t.date, t.time, h.type, t.customer_id, {', '.join(f'sum({c}) AS {c}' for c in _T8)},
    sum(total_sale_qty) AS total_sale_sku_qty, sum(total_margin_amt) AS total_margin
    FROM c_trans t LEFT JOIN (SELECT DISTINCT transaction_id, substring(o_orderpriority, 1, 1) AS type FROM c_ticket) h USING (transaction_id)
    GROUP BY ALL""")
add("d09_campaign_days", mart("campaign_days"), "promo_id promo_year:i date", "c_days")
add("d10_promo_days", on(lambda m: totals(m["promo_days"], ["promo_id", "date", "store_id"], [], [F.count_distinct("sku_id").alias("skus")])),
    "promo_id date store_id n_rows:i skus:i",
    """SELECT o.promo_id, d.date, o.store_id, count(*) AS n_rows, count(DISTINCT o.sku_id) AS skus
    FROM (SELECT DISTINCT sku_id, sku_root_id, store_id, promo_id, promo_year FROM c_offer) o
    JOIN c_days d ON d.promo_id = o.promo_id AND d.promo_year = o.promo_year GROUP BY ALL""")
add("d11_vendor_funding", mart("vendor_funding"), "sku_id sku_root_id expected_vendor_funding_per_unit:d", "c_funding")
add("d12_root_sku", mart("root_sku"),
    "sku_root_id description area section category subcategory segment brand_name own_brand_flag own_brand_label flag_healthy "
    "wow_flag cost_per_unit:d expected_vendor_funding_per_unit:d", "c_root")
add("d13_promo_root_days", on(lambda m: totals(m["promo_root_days"], ["date", "sku_root_id"], [], [F.count_distinct("store_id").alias("stores")])),
    "date sku_root_id n_rows:i stores:i",
    "SELECT date, sku_root_id, count(*) AS n_rows, count(DISTINCT store_id) AS stores FROM c_rootdays GROUP BY ALL")

# --- dense facts ------------------------------------------------------------

add("d14_daily_root_promo", mart("daily_root_promo"),
    f"date sku_root_id store_id promo_id promo_year:i std_price_per_unit:d {_d(MEASURES)}", "c_actual")


def _span() -> list[Column]:
    return [F.min("date").alias("first_day"), F.max("date").alias("last_day")]


add("d15_dense_grid", on(lambda m: totals(m["grid"], ["sku_root_id", "store_id"], [], _span())),
    "sku_root_id store_id n_rows:i first_day last_day",
    "SELECT sku_root_id, store_id, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day FROM c_grid GROUP BY ALL")
add("d16_grid_promos", on(lambda m: totals(m["grid_promos"], ["sku_root_id", "store_id", "promo_id", "promo_year"], [], _span())),
    "sku_root_id store_id promo_id promo_year:i n_rows:i first_day last_day",
    """SELECT sku_root_id, store_id, promo_id, promo_year, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day
    FROM c_gridpromo GROUP BY ALL""")
_SIX = ["total_sale_amt", "total_sale_qty", "total_margin_amt", "total_price_if_sku_std_price", "oferta_promo_total_sale_qty", "total_sale_amt_std"]
add("d17_gap_fill", on(lambda m: m["filled"].groupBy("sku_root_id", "store_id", "promo_id", "promo_year").agg(
        F.count_distinct("date").alias("days"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SIX])),
    f"sku_root_id store_id promo_id promo_year:i days:i {_d(_SIX)}",
    f"""SELECT sku_root_id, store_id, promo_id, promo_year, count(DISTINCT date) AS days, {', '.join(f'sum({c}) AS {c}' for c in _SIX)}
    FROM c_filled GROUP BY ALL""")
_MONTH = "date_trunc('month', date)::DATE AS month"


def _month() -> Column:
    return F.to_date(F.date_trunc("month", "date")).alias("month")


_MIX = ["total_sale_amt", "total_sale_qty", "total_margin_amt", "total_non_oferta_discount_amt", "oferta_promo_total_sale_amt",
        "oferta_promo_total_discount_amt", "std_price_per_unit", "n_promo", "promo_flag"]
add("d18_daily_transaction_to_sku_promo", on(lambda m: totals(m["daily_promo"], [_month(), "sku_root_id", "store_id", "promo_id"], _MIX)),
    f"month sku_root_id store_id promo_id n_rows:i {_d(_MIX)}",
    totals_sql("c_dailypromo", f"{_MONTH}, sku_root_id, store_id, promo_id", _MIX))
add("d19_daily_transaction_to_sku", on(lambda m: totals(
        m["daily"], [_month(), "sku_root_id", "store_id"], _MIX, [F.max(F.array_join("promo_id_list", ",")).alias("top_list")])),
    f"month sku_root_id store_id n_rows:i top_list {_d(_MIX)}",
    totals_sql("c_daily", f"{_MONTH}, sku_root_id, store_id", _MIX, ", max(array_to_string(promo_id_list, ',')) AS top_list"))
add("d20_weekly_transaction_to_sku_promo", on(lambda m: totals(m["weekly_promo"], ["date", "store_id", "promo_id"], [*_MIX, "no_days_with_promo"])),
    f"date store_id promo_id n_rows:i {_d(_MIX)} no_days_with_promo:i",
    totals_sql("c_weeklypromo", "date, store_id, promo_id", [*_MIX, "no_days_with_promo"]))
add("d21_weekly_transaction_to_sku", mart("weekly"),
    "date sku_root_id store_id promo_id_list:l total_sale_amt:d total_sale_qty:d total_margin_amt:d std_price_per_unit:d "
    "oferta_promo_total_sale_qty:d n_promo:i promo_flag:i no_days_with_promo:i", "c_weekly")
for _name, _src in (("daily", "c_daily"), ("weekly", "c_weekly")):
    add(f"d22_{_name}_summary", on(lambda m, n=_name: facts.with_root(facts.summary(m[n]), m["root_sku"])),
        f"date sku_root_id description area section category subcategory segment brand_name promo_flag:i {_d(facts.SUMMARY_MEASURES)} std_price_per_unit:d",
        f"""SELECT s.*, r.description, r.area, r.section, r.category, r.subcategory, r.segment, r.brand_name FROM (
        SELECT date, sku_root_id, max(promo_flag) AS promo_flag, {o.csum(facts.SUMMARY_MEASURES)},
        {o.fixed(o.mean('std_price_per_unit'))} AS std_price_per_unit FROM {_src} GROUP BY ALL) s JOIN c_root r USING (sku_root_id)""")
add("d23_std_price_margin", mart("std_price_margin"), "sku_root_id margin_per_unit:d std_price_per_unit:d cost_per_unit:d", "c_price")

# --- facts without zero days, clustered and kept up by batch -----------------

_WEEKLY = ("date sku_root_id store_id promo_id_list:l total_sale_amt:d total_sale_qty:d total_margin_amt:d std_price_per_unit:d "
           "oferta_promo_total_sale_qty:d n_promo:i promo_flag:i no_days_with_promo:i")
_DAY_SUMMARY = f"date sku_root_id promo_flag:i {_d(facts.SUMMARY_MEASURES)} std_price_per_unit:d"
_DAY_SUMMARY_SQL = f"""SELECT date, sku_root_id, max(promo_flag) AS promo_flag, {o.csum(facts.SUMMARY_MEASURES)},
{o.fixed(o.mean('std_price_per_unit'))} AS std_price_per_unit FROM c_daily GROUP BY ALL"""
add("d15_zero_runs", mart("zero_runs"), "sku_root_id store_id first_day last_day",
    """SELECT sku_root_id, store_id, min(date) AS first_day, max(date) AS last_day FROM (
    SELECT *, date - row_number() OVER (PARTITION BY sku_root_id, store_id ORDER BY date)::INTEGER AS run FROM (
      SELECT date::DATE AS date, sku_root_id, store_id FROM c_grid EXCEPT SELECT date::DATE, sku_root_id, store_id FROM c_actual
      EXCEPT SELECT date::DATE, sku_root_id, store_id FROM c_rootdays)) GROUP BY sku_root_id, store_id, run""")
add("d18_sparse_daily_promo", on(lambda m: totals(sparse.dense(m["carrying"], m["zero_runs"]), [_month(), "sku_root_id", "store_id", "promo_id"], _MIX)),
    f"month sku_root_id store_id promo_id n_rows:i {_d(_MIX)}",
    totals_sql("c_dailypromo", f"{_MONTH}, sku_root_id, store_id, promo_id", _MIX))
add("d20_sparse_weekly_promo", mart("sparse_weekly_promo"),
    f"date sku_root_id store_id promo_id promo_year:i {_d(_MIX)} no_days_with_promo:i", "c_weeklypromo")
add("d21_sparse_weekly", on(lambda m: facts.weekly(m["sparse_weekly_promo"])), _WEEKLY, "c_weekly")
add("d22_sparse_daily_summary", on(lambda m: sparse.daily_summary(sparse.daily(m["carrying"]), m["calendar"])), _DAY_SUMMARY, _DAY_SUMMARY_SQL)


def _sparse_weekdays(m: Mart) -> DataFrame:
    days = sparse.daily(m["carrying"])
    return sparse.avg_per_weekday(days, uplift.active_period(days))


add("d64_sparse_weekday_average", on(_sparse_weekdays), "sku_root_id store_id dayweek total_sale_qty:d period:i", "c_perweekday")


def _clustered(m: Mart, name: str) -> DataFrame:
    """A daily fact by month, bucketed by root and store; written once."""
    key = f"clustered_{name}"
    if key not in m._made:
        buckets = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"{key}_{m.space.folder[-12:]}"
        m._made[key] = write_clustered(m[name], table, f"{m.space.folder}/{key}", buckets, facts.PAIR)
    return m._made[key]


add("s09_clustered_weekly", on(lambda m: facts.weekly(facts.weekly_promo(_clustered(m, "daily_promo")))), _WEEKLY, "c_weekly")
add("s09_clustered_days", on(lambda m: between_days(_clustered(m, "daily_promo"), D(1996, 2, 10), D(1996, 4, 3))),
    f"date sku_root_id store_id promo_id promo_year:i {_d(_MIX)}", "SELECT * FROM c_dailypromo WHERE date BETWEEN DATE '1996-02-10' AND DATE '1996-04-03'")


def _upkept(m: Mart) -> FactStore:
    """All tickets in two batches: those up to the middle of 1996 but for late ones, then the late ones and the rest."""
    if "upkept" not in m._made:
        store, cut = FactStore(m.spark, f"{m.space.folder}/upkept", 2, "year"), F.lit(D(1996, 6, 12))
        early = (F.col("date") <= cut) & (F.pmod(F.xxhash64("transaction_id"), F.lit(40)) != 0)
        fixed = (m["root_sku"], m["campaign"], m["campaign_days"], m["promo_to_sku"])
        store.apply(1, m["trans"].where(early), *fixed, m["calendar"].where(F.col("date") <= cut))
        store.apply(2, m["trans"].where(~early), *fixed, m["calendar"])
        m._made["upkept"] = store
    return m._made["upkept"]


add("s14_upkept_weekly", on(lambda m: _upkept(m)["weekly"]), _WEEKLY, "c_weekly")
add("s14_upkept_daily_summary", on(lambda m: _upkept(m)["daily_summary"]), _DAY_SUMMARY, _DAY_SUMMARY_SQL)

# --- promo facts ------------------------------------------------------------

_PK = ["promo_id", "promo_year", "sku_root_id", "promo_mechanic", "discount_depth"]
_PKS = "promo_id promo_year:i sku_root_id promo_mechanic discount_depth"
add("d24_promo_daily_detail", on(lambda m: totals(promo_facts.with_attributes(m["promo_daily"], m["campaign_detail"], m["root_sku"], m["store"]),
        [*_PK, "duration", "campaign_start_day", "campaign_start_month", "store_format"], ["std_price", "discounted_price_promo", *promo_facts.DISPLAY])),
    f"{_PKS} duration:i campaign_start_day campaign_start_month store_format n_rows:i {_d(['std_price', 'discounted_price_promo'])} {_DISP}",
    f"""SELECT p.promo_id, p.promo_year, sku_root_id, promo_mechanic, discount_depth, (end_date - start_date + 1)::INT AS duration, dayname(start_date) AS campaign_start_day,
    CASE WHEN month(start_date) = 9 THEN 'Sept' ELSE strftime(start_date, '%b') END AS campaign_start_month, store_type1 AS store_format,
    count(*) AS n_rows, sum(std_price) AS std_price, sum(discounted_price_promo) AS discounted_price_promo,
    {', '.join(f'sum({c}) AS {c}' for c in promo_facts.DISPLAY)}
    FROM c_pday p JOIN c_campaign c ON c.promo_id = p.promo_id AND c.promo_year = p.promo_year JOIN c_store s USING (store_id) GROUP BY ALL""")
_AL = [*promo_facts.ALLOCATED, *OFFER_MEASURES]
add("d25_allocated_sales", on(lambda m: totals(m["allocated"], [*_PK, "store_id"], [*_AL, "n_promo_mech", "n_promo", "discount_depth_10"])),
    f"{_PKS} store_id n_rows:i {_d(_AL)} n_promo_mech:i n_promo:i discount_depth_10:d",
    totals_sql("c_alloc", "promo_id, promo_year, sku_root_id, promo_mechanic, discount_depth, store_id", [*_AL, "n_promo_mech", "n_promo", "discount_depth_10"]))
add("d26_matched_offers", on(lambda m: totals(m["matched"], ["promo_id", "promo_mechanic"], ["n_promo"])),
    "promo_id promo_mechanic n_rows:i n_promo:i", totals_sql("c_matched", "promo_id, promo_mechanic", ["n_promo"]))
_D27 = "discounted_price_promo:d std_price:d discount_depth_10:d"
add("d27_depth_by_store", on(lambda m: promo_facts.depth_by_store(m["matched"])), f"promo_id promo_year:i sku_root_id store_id {_D27}", "c_depthstore")
add("d27_depth_summary", mart("depths"), f"promo_id promo_year:i sku_root_id promo_mechanic discount_depth discount_depth_rank:d {_D27}", "c_depth")
_NEAR = ["promo_prev_week", "promo_pf_week"]
add("d28_daily_total_promo", on(lambda m: totals(m["promo_daily_total"], ["date", "sku_root_id", "promo_mechanic", "discount_depth"], [*_AL, *_NEAR, "discount_depth_rank"])),
    f"date sku_root_id promo_mechanic discount_depth n_rows:i {_d(_AL)} promo_prev_week:i promo_pf_week:i discount_depth_rank:d",
    totals_sql("c_pdtotal", "date, sku_root_id, promo_mechanic, discount_depth", [*_AL, *_NEAR, "discount_depth_rank"]))
add("d29_weekly_total_promo", on(lambda m: totals(m["promo_weekly_total"], ["date", *_PK, "includes_weekend"], [*_AL, *_NEAR, "n_days_promo_week"])),
    f"date {_PKS} includes_weekend n_rows:i {_d(_AL)} promo_prev_week:i promo_pf_week:i n_days_promo_week:i",
    totals_sql("c_pwtotal", "date, promo_id, promo_year, sku_root_id, promo_mechanic, discount_depth, includes_weekend", [*_AL, *_NEAR, "n_days_promo_week"]))
_QTY = ["s_prev_bl_qty", "s_prev_bl_qty_norm", "pf_after_bl_qty", "avg_bline_qty", "avg_bline_qty_all"]
_CNT = " ".join(f"{c}:i" for c in [*promo_facts.FORMAT_COUNTS.values(), "no_impacted_stores", "no_impacted_regions", "n_promo_mech", "n_promo", *_NEAR])
add("d30_promo_summary", mart("promo_summary"),
    f"date {_PKS} promo_mechanic_description discount_depth_rank:d includes_weekend store_ids:l avg_store_size:d n_days_promo_week:d {_CNT} {_DISP} {_d(_AL)} {_d(_QTY)}",
    "c_psum")
_PF = ["pf_sale_amt", "pf_sale_qty", "pf_margin_amt", "pf_n_promo", "pf_promo_flag", "n_promo_mech", "promo_prev_week"]
add("d31_post_promo_days", on(lambda m: totals(m["post_promo"], ["date", "sku_root_id", "promo_mechanic", "discount_depth"], _PF)),
    f"date sku_root_id promo_mechanic discount_depth n_rows:i {_d(_PF)}",
    totals_sql("c_post", "date, sku_root_id, promo_mechanic, discount_depth", _PF))
add("d32_sku_campaign_dates", mart("sku_campaign_dates"),
    "promo_id promo_year:i name start_date end_date start_day end_day sku_root_id description area segment brand_name",
    """SELECT DISTINCT c.promo_id, c.promo_year, c.name, start_date, end_date, dayname(start_date) AS start_day, dayname(end_date) AS end_day,
    r.sku_root_id, r.description, r.area, r.segment, r.brand_name FROM c_campaign c JOIN c_offer o ON o.promo_id = c.promo_id AND o.promo_year = c.promo_year
    JOIN c_root r ON r.sku_root_id = o.sku_root_id""")
add("d33_customer", mart("customer"),
    "customer_id club_loyalty_member gold_member travel_card_member gender age:i location",
    """SELECT c_custkey::VARCHAR AS customer_id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'ALTA PENDIENTE CONFIRMACION' ELSE '1' END AS club_loyalty_member,
    CASE WHEN c_acctbal > 5000 THEN '1' ELSE 'ALTA PENDIENTE CONFIRMACION' END AS gold_member, CASE WHEN c_custkey % 2 = 0 THEN '1' END AS travel_card_member,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 2019 - year(born) - CASE WHEN dayofyear(DATE '2019-12-01') < dayofyear(born) THEN 1 ELSE 0 END AS age,
    c_nationkey::VARCHAR AS location FROM (SELECT *, DATE '1940-01-01' + (c_custkey * 37 % 20000)::INT AS born FROM customer)""")

# --- promotion counterfactual -----------------------------------------------------

_ID = "date uniq_id sku_root_id promo_id promo_year promo_mechanic discount_depth"
add("d34_sections", on(lambda m: counterfactual.sections(m["root_sku"])), "area section", "SELECT DISTINCT area, section FROM c_root")
add("d34_promo_weeks", on(lambda m: counterfactual.promo_weeks(m["promo_summary"], m["root_sku"])),
    f"{_ID} section total_sale_qty:d s_prev_bl_qty:d pf_after_bl_qty:d", "c_pweeks")
add("d34_unpromoted_sales", on(lambda m: counterfactual.unpromoted_sales(m["weekly"], m["root_sku"])), "date sku_root_id section sale_qty_np:d",
    """SELECT date, sku_root_id, section, sum(total_sale_qty) AS sale_qty_np FROM c_weekly JOIN c_root r USING (sku_root_id)
    WHERE promo_flag = 0 GROUP BY ALL""")
add("d35_level_trend", on(lambda m: counterfactual.level_trend(counterfactual.unpromoted_sales(m["weekly"], m["root_sku"]))),
    "date section sale_qty_np:d sale_qty_pct:d", "c_trend")
add("d36_promotion_ids", on(lambda m: counterfactual.promo_weeks(m["promo_summary"], m["root_sku"], require_neighbours=False)
        .groupBy("uniq_id").agg(F.count(F.lit(1)).alias("weeks"))), "uniq_id weeks:i",
    """SELECT sku_root_id || '-' || promo_id || '-' || promo_year || '-' || promo_mechanic || '-' || coalesce(discount_depth, 'ISNULL') AS uniq_id,
    count(*) AS weeks FROM c_psum GROUP BY ALL""")
add("d37_extension_weeks", on(lambda m: counterfactual.extended_weeks(counterfactual.promo_weeks(m["promo_summary"], m["root_sku"]))),
    f"{_ID} change_flag:i total_sale_qty:d", "c_ext")
_BL = f"{_ID} change_flag:i total_sale_qty:d sale_qty_bl:d sale_qty_pct:d"
add("d38_recursive_counterfactual", mart("counterfactual"), _BL, "c_counterfactual")


def _filtered(m: Mart) -> DataFrame:
    chosen = m["promo_summary"].where(F.col("promo_mechanic").isin("10", "20", "40"))
    return counterfactual.promo_counterfactual(chosen, m["weekly"], m["root_sku"], require_neighbours=False)


add("d39_filtered_counterfactual", on(_filtered), _BL, "c_counterfactual", extra={"c_pweeks": o.CTE["c_pweeks"].replace(
    "s_prev_bl_qty IS NOT NULL AND pf_after_bl_qty IS NOT NULL", "promo_mechanic IN ('10', '20', '40')")})

_INC = ["inc_sale_amt", "inc_sale_qty", "inc_margin_amt", "avg_bl_inc_sale", "avg_bl_inc_qty", "avg_bl_inc_margin"]
_TT = ["tt_sale_qty", "tt_sale_amt", "tt_margin_amt", "tt_discount", "sale_qty_bl", "sale_amt_bl", "margin_amt_bl",
       "avg_bline_qty", "avg_bline_sale", "avg_bline_margin", "s_prev_bl_qty", "pf_after_bl_qty", "avg_store_size", "discount_depth_rank"]
add("d40_counterfactual_promo", mart("counterfactual_promo"),
    f"{_ID} change_flag:i includes_weekend promo_flag:i store_promo_flag:i no_impacted_stores:i no_hipermercados_stores:i in_gondola_flag:i {_d(_TT)} {_d(_INC)}", "c_bp")

_SC = """SELECT unnest([section, category]) AS sec_cat, sku_root_id, m AS inc_margin_amt, a AS inc_sale_amt, q AS inc_sale_qty FROM (
  SELECT sku_root_id, sum(coalesce(inc_margin_amt, 0))::DECIMAL(18,6) AS m, sum(coalesce(inc_sale_amt, 0))::DECIMAL(18,6) AS a,
  sum(coalesce(inc_sale_qty, 0))::DECIMAL(18,6) AS q FROM c_bp GROUP BY 1) JOIN c_root USING (sku_root_id)"""
_PT = """SELECT promo_id, promo_year, sku_root_id, sum(inc_margin_amt)::DECIMAL(18,6) AS inc_margin_amt, sum(inc_sale_amt)::DECIMAL(18,6) AS inc_sale_amt,
  sum(inc_sale_qty)::DECIMAL(18,6) AS inc_sale_qty FROM c_bp GROUP BY ALL"""


def _rank_sql(src: str, keys: str) -> str:
    over = "round(percent_rank() OVER (PARTITION BY {k} ORDER BY {m} NULLS FIRST), 2)"
    cols = ", ".join(f"{over.format(k=keys, m=m)} AS {r}" for m, r in
                     (("inc_margin_amt", "margin_rank"), ("inc_sale_amt", "sale_rank"), ("inc_sale_qty", "qty_rank")))
    return f"SELECT *, {cols} FROM ({src})"


_PEX = {"c_secrank": _rank_sql(_SC, "sec_cat"), "c_promorank": _rank_sql(_PT, "promo_id, promo_year")}


def _pareto_sql(src: str, keys: str, prefix: str) -> str:
    parts = []
    for m, r, label in (("margin_amt", "margin_rank", "margin"), ("sale_amt", "sale_rank", "sale"), ("sale_qty", "qty_rank", "qty")):
        parts.append(f"""(SELECT {keys}, {r} AS percentile_rank_inc, sum(inc_{m})::DECIMAL(18,6) AS {prefix}_{m},
        string_agg(sku_root_id || '=' || coalesce(inc_{m}::VARCHAR, ''), ',' ORDER BY sku_root_id) AS {label} FROM {src} GROUP BY ALL)""")
    using = f"USING ({keys}, percentile_rank_inc)"
    return f"SELECT * FROM {parts[0]} a FULL JOIN {parts[1]} b {using} FULL JOIN {parts[2]} c {using}"


def _pareto_text(df: DataFrame, prefix: str) -> DataFrame:
    labels = {"margin": f"{prefix}_margin_amt", "sale": f"{prefix}_sale_amt", "qty": f"{prefix}_sale_qty"}

    def text(label: str, name: str):
        return F.array_join(F.transform(label, lambda x: F.concat(x["sku_root_id"], F.lit("="), F.coalesce(x[name].cast("string"), F.lit("")))), ",")

    return df.withColumns({label: text(label, name) for label, name in labels.items()})


add("d41_pareto_section_sku", on(lambda m: _pareto_text(dashboards.pareto_section_sku(m["counterfactual_promo"], m["root_sku"]), "incremental")),
    "sec_cat percentile_rank_inc:d incremental_margin_amt:d margin incremental_sale_amt:d sale incremental_sale_qty:d qty",
    _pareto_sql("c_secrank", "sec_cat", "incremental"), extra=_PEX)
_RANKS = "inc_margin_amt:d margin_rank:d inc_sale_amt:d sale_rank:d inc_sale_qty:d qty_rank:d"
add("d42_pareto_sku_table", on(lambda m: dashboards.pareto_sku_table(m["counterfactual_promo"], m["root_sku"])),
    f"sec_cat sku_root_id description section category subcategory segment {_RANKS}",
    "SELECT k.*, r.description, r.section, r.category, r.subcategory, r.segment FROM c_secrank k LEFT JOIN c_root r USING (sku_root_id)", extra=_PEX)
add("d43_pareto_promo", on(lambda m: _pareto_text(dashboards.pareto_promo(m["counterfactual_promo"]), "inc")),
    "promo_id promo_year percentile_rank_inc:d inc_margin_amt:d margin inc_sale_amt:d sale inc_sale_qty:d qty",
    _pareto_sql("c_promorank", "promo_id, promo_year", "inc"), extra=_PEX)
add("d44_pareto_promo_table", on(lambda m: dashboards.pareto_promo_table(m["counterfactual_promo"], m["campaign"], m["root_sku"])),
    f"promo_id promo_year name start_date end_date duration:i st_date_month:i sku_root_id description area section category subcategory segment discount:d {_RANKS}",
    """SELECT k.*, c.name, c.start_date, c.end_date, (c.end_date - c.start_date + 1)::INT AS duration, month(c.start_date) AS st_date_month,
    r.description, r.area, r.section, r.category, r.subcategory, r.segment, d.discount FROM c_promorank k
    JOIN (SELECT promo_id, promo_year, sku_root_id, sum(tt_discount) AS discount FROM c_bp GROUP BY ALL) d USING (promo_id, promo_year, sku_root_id)
    JOIN c_campaign c ON c.promo_id = k.promo_id AND c.promo_year::VARCHAR = k.promo_year JOIN c_root r ON r.sku_root_id = k.sku_root_id""", extra=_PEX)

# --- cannibalisation --------------------------------------------------------

_MET = counterfactual.METRICS
add("d46_segment_promo_count", on(lambda m: cannibal.segment_promo_count(m["sku_counterfactual"])),
    "date sku_root_id segment promo_flag_binary:i incremental_qty:d cb_flag_temp:i",
    "SELECT date, sku_root_id, segment, pf AS promo_flag_binary, incremental_qty, cnt AS cb_flag_temp FROM c_cb0")
add("d47_cannibal_flags", on(lambda m: cannibal.cannibal_flags(cannibal.segment_promo_count(m["sku_counterfactual"]))),
    "date sku_root_id segment change_flag:i cb_flag:i", "c_cb1")
_CBB = [f"{m}_cb_bl" for m in _MET]
_CBL = [f"cb_{m}" for m in _MET]
_flagged = on(lambda m: cannibal.cannibal_counterfactual(cannibal.cannibal_flags(cannibal.segment_promo_count(m["sku_counterfactual"]))))
add("d48_cannibal_counterfactual", _flagged, f"date sku_root_id segment cb_flag:i {_d(_CBB)}", "c_cb")
add("d49_cannibalised_amount", _flagged, f"date sku_root_id segment {_d(_CBL)}", "c_cb")


def _attributed_sql(positive: bool) -> str:
    src = "c_cb"
    if positive:
        cols = ", ".join(f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}" for c in ["incremental_qty", *_CBB, *_CBL])
        src = f"(SELECT * REPLACE ({cols}) FROM c_cb)"
    return f"""SELECT x.date, x.segment, x.sku_root_id, x.cb_flag, {', '.join('x.' + c for c in _CBB)},
    t0 * share AS ind_cb_sale, t1 * share AS ind_cb_qty, t2 * share AS ind_cb_margin FROM (
    SELECT a.*, coalesce({o.ratio('a.incremental_qty', 'b.inc')}, 0) AS share, {', '.join(f'b.t{i}' for i in range(3))} FROM {src} a JOIN (
      SELECT date, segment, sum({o.fixed('incremental_qty')})::DOUBLE AS inc, {', '.join(f'coalesce(sum({o.fixed(c)})::DOUBLE, 0) AS t{i}' for i, c in enumerate(_CBL))}
      FROM {src} GROUP BY ALL) b USING (date, segment)) x"""


_ATT = f"date segment sku_root_id cb_flag:i {_d(_CBB)} ind_cb_sale:d ind_cb_qty:d ind_cb_margin:d"
add("d50_cannibal_attribution", mart("cannibalisation"), _ATT, _attributed_sql(False))
add("d50_cannibal_attribution_positive", on(lambda m: cannibal.cannibalisation(m["sku_counterfactual"], negatives="positive")), _ATT, _attributed_sql(True))

# --- forward counterfactual -------------------------------------------------------

_FEX = {
    "c_hist": " UNION ALL ".join(
        f"SELECT sku_root_id, date, '{m}' AS measure, CASE WHEN change_flag = 0 THEN total_{m}::DOUBLE WHEN change_flag IN (1, 2) THEN {m}_bl ELSE {m}_bl_ext END AS hist FROM c_sb"
        for m in _MET),
    "c_shift": """SELECT h.*, low, CASE WHEN low > 1000 THEN 0 WHEN low >= 0 AND low < 1000 THEN 1000 WHEN low < 0 THEN 1000 - low ELSE low END AS shift
      FROM c_hist h JOIN (SELECT sku_root_id, measure, min(hist) AS low FROM c_hist GROUP BY ALL) USING (sku_root_id, measure)""",
    "c_smooth": f"""SELECT * FROM (SELECT *, CASE WHEN count(x) OVER f = 4 THEN (sum(x) OVER f)::DOUBLE / 4 END AS smooth, row_number() OVER (PARTITION BY sku_root_id, measure ORDER BY date) AS rn
      FROM (SELECT *, {o.fixed('hist + shift')} AS x FROM c_shift)
      WINDOW f AS (PARTITION BY sku_root_id, measure ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) WHERE rn >= 4 AND smooth IS NOT NULL""",
}
add("d51_history_series", on(lambda m: forecast.history(m["sku_counterfactual"])), "sku_root_id date measure hist:d", "c_hist", extra=_FEX)
add("d52_positive_shift", on(lambda m: forecast.positive_shift(forecast.history(m["sku_counterfactual"]))),
    "sku_root_id date measure low:d shift:d", "c_shift", extra=_FEX)
_smoothed = lambda m: forecast.smoothed(forecast.positive_shift(forecast.history(m["sku_counterfactual"])))
add("d53_smoothed_history", on(_smoothed), "sku_root_id date measure smooth:d", "c_smooth", extra=_FEX)
_GIVEN = (0.4, 0.1, 0.3, 0.95)
_FIT_SQL = {
    "c_series": """SELECT *, row_number() OVER w AS t, count(*) OVER (PARTITION BY sku_root_id, measure) AS n FROM c_smooth
      WINDOW w AS (PARTITION BY sku_root_id, measure ORDER BY date)""",
    "c_start": """SELECT sku_root_id, measure, avg(smooth) FILTER (WHERE t <= 12) AS l,
      (avg(smooth) FILTER (WHERE t > 12 AND t <= 24) - avg(smooth) FILTER (WHERE t <= 12)) / 12 AS b, list(smooth ORDER BY t) FILTER (WHERE t <= 12) AS y FROM c_series WHERE n >= 24 GROUP BY ALL""",
    "c_run": """SELECT sku_root_id, measure, 0 AS t, NULL::DATE AS date, NULL::DOUBLE AS hist, NULL::DOUBLE AS shift, NULL::DOUBLE AS y, NULL::DOUBLE AS fit, l, b, list_transform(y, lambda v: v - l) AS s FROM c_start
      UNION ALL
      SELECT r.sku_root_id, r.measure, x.t, x.date, x.hist::DOUBLE, x.shift::DOUBLE, x.smooth, r.l + 0.95::DOUBLE * r.b + r.s[1],
        0.4::DOUBLE * (x.smooth - r.s[1]) + 0.6::DOUBLE * (r.l + 0.95::DOUBLE * r.b),
        0.1::DOUBLE * (0.4::DOUBLE * (x.smooth - r.s[1]) + 0.6::DOUBLE * (r.l + 0.95::DOUBLE * r.b) - r.l) + 0.9::DOUBLE * 0.95::DOUBLE * r.b,
        list_append(r.s[2:], 0.3::DOUBLE * (x.smooth - r.l - 0.95::DOUBLE * r.b) + 0.7::DOUBLE * r.s[1])
      FROM c_run r JOIN c_series x ON x.sku_root_id = r.sku_root_id AND x.measure = r.measure AND x.t = r.t + 1""",
    "c_bias": "SELECT sku_root_id, measure, avg(y - fit) AS bias, max(t) AS last FROM c_run WHERE t > 0 GROUP BY ALL",
    "c_ahead": """SELECT r.sku_root_id, r.measure, (r.date + (7 * h)::INT)::DATE AS date, NULL::DOUBLE AS y_t, NULL::DOUBLE AS l_t, NULL::DOUBLE AS b_t, NULL::DOUBLE AS s_t,
      r.l + list_sum(list_transform(range(1, h + 1), lambda k: 0.95::DOUBLE ** k)) * r.b + r.s[(h - 1) % 12 + 1] + bias - r.shift AS e
      FROM c_run r JOIN c_bias USING (sku_root_id, measure), range(1, 17) g(h) WHERE r.t = last""",
    "c_fitted": """SELECT sku_root_id, measure, date, hist AS y_t, l AS l_t, b AS b_t, s[12] AS s_t, fit + bias - shift AS e FROM c_run JOIN c_bias USING (sku_root_id, measure) WHERE t > 0
      UNION ALL SELECT * FROM c_ahead
      UNION ALL SELECT sku_root_id, measure, date, hist::DOUBLE, NULL, NULL, NULL, NULL FROM c_series WHERE n < 24""",
}
# Cents: the engines sum in different orders.
add("d54_forecast_given", on(lambda m: forecast.fit_and_forecast(_smoothed(m), params=_GIVEN).select("sku_root_id", "measure", "date", "y_t", *[(F.round(c, 2) + 0.0).alias(c) for c in ("l_t", "b_t", "s_t", "y_hat_t")])),
    "sku_root_id measure date y_t:d l_t:d b_t:d s_t:d y_hat_t:d",
    """SELECT sku_root_id, measure, date, y_t, round(l_t, 2) + 0.0 AS l_t, round(b_t, 2) + 0.0 AS b_t, round(s_t, 2) + 0.0 AS s_t,
    round(CASE WHEN measure <> 'margin_amt' THEN greatest(e, 0) ELSE e END, 2) + 0.0 AS y_hat_t FROM c_fitted""", extra={**_FEX, **_FIT_SQL}, recursive={"c_run"})
add("d54_forecast", on(lambda m: forecast.forecast_table(m["forecast"])),
    "date sku_root_id " + _d([f"{n}_{x}" for x in _MET for n in ("b_t", "l_t", "s_t", "y_hat_t", "y_t")]))


def _given_fit(m: Mart) -> DataFrame:
    """Figures of the seasonal forecast with given parameters, forecasts in cents as in ``d54_forecast_given``."""
    rows = forecast.fit_and_forecast(_smoothed(m), params=_GIVEN).withColumn("y_hat_t", F.round("y_hat_t", 2))
    return forecast.fit_metrics(rows)


_GAP = o.fixed("(y_t - y_hat_t) * (y_t - y_hat_t)")
_CENTS = "SELECT *, round(CASE WHEN measure <> 'margin_amt' THEN greatest(e, 0) ELSE e END, 2) AS y_hat_t FROM c_fitted"
_FIT_SQL = {**_FIT_SQL, "c_cents": _CENTS, "c_given": f"""SELECT sku_root_id, 'pred_counterfactual_' || measure AS metric, sum({_GAP})::DOUBLE AS SSE, {o.mean(_GAP)} AS MSE, sqrt({o.mean(_GAP)}) AS RMSE,
    {o.mean(o.fixed('abs(y_t - y_hat_t)'))} AS MAE, coalesce({o.mean(o.fixed('y_hat_t'), "y_t IS NULL")}, {o.mean(o.fixed('y_t'))}) AS avg_forecast_period,
    CASE WHEN count(*) FILTER (WHERE y_hat_t IS NULL) > 0 THEN 0 ELSE 1 END AS convergence_flag FROM c_cents GROUP BY ALL"""}
# Squares above 2^33 have no six decimals that both engines share, so sums of squares are compared in cents.
add("d55_fit_metrics", on(lambda m: _given_fit(m).withColumns({c: F.round(c, 2) for c in ("SSE", "MSE", "RMSE")})), "sku_root_id metric SSE:d MSE:d RMSE:d MAE:d avg_forecast_period:d convergence_flag:i",
    "SELECT * REPLACE (round(SSE, 2) AS SSE, round(MSE, 2) AS MSE, round(RMSE, 2) AS RMSE) FROM c_given", extra={**_FEX, **_FIT_SQL}, recursive={"c_run"})
add("d45_forecast_republish", on(lambda m: forecast.republish(m["forecast_metrics"])),
    "sku_root_id metric alpha:d beta:d phi:d gamma:d l_0:d b_0:d SSE:d MSE:d RMSE:d MAE:d avg_forecast_period:d convergence_flag:i")

# --- price elasticity -------------------------------------------------------

add("d56_price_points", mart("price_points"),
    "sku_root_id store_id std_price_per_unit:d avg_sales_qty:d actual_price:d duration_weeks:i std_dev_sales_qty:r", "c_point")
add("d56_price_points_avg", on(lambda m: elasticity.price_points(m["daily"], m["root_sku"], qty_agg="avg")),
    "sku_root_id store_id std_price_per_unit:d avg_sales_qty:d actual_price:d duration_weeks:i", "c_point",
    extra={"c_point": o.CTE["c_point"].replace(o.fixed("sum(total_sale_qty)") + " AS qty", o.fixed(o.mean("total_sale_qty")) + " AS qty")})
add("d57_unit_cost", mart("unit_cost"), "sku_root_id cost_per_unit:d category",
    "SELECT DISTINCT p.sku_root_id, p.cost_per_unit, s.category FROM c_price p JOIN c_sku s USING (sku_root_id)")
add("d58_store_regressions", mart("store_lines"),
    "sku_root_id store_id coeficient:r intercept:r R2:r Nfactor:d points:i avg_price:d gradient:r cost_per_unit:d", "c_sline")
_STEEP = f"""(SELECT * FROM (SELECT *, {o.fixed('gradient')} AS g, avg({o.fixed('gradient')}) OVER (PARTITION BY sku_root_id) AS mg FROM c_sline
  WHERE coeficient < 0 AND points > 2) WHERE gradient <= mg)"""
add("d59_sku_elasticity", on(lambda m: elasticity.sku_elasticity(m["price_points"], m["store_lines"])),
    "sku_root_id gradient:r m:r intercept:r Pmax:r R2:r std:r store_count:i cost_per_unit:d average_price:d optimal_price:r percentage_change:r",
    f"""SELECT *, {o.ratio('optimal_price - average_price', 'average_price')} AS percentage_change FROM (
    SELECT *, gradient * avg_qty AS m, {o.ratio('-intercept', 'gradient')} AS Pmax, {o.ratio('intercept - gradient * cost_per_unit::DOUBLE', '-gradient * 2')} AS optimal_price FROM (
    SELECT a.*, b.avg_qty, b.average_price, 1 - gradient * average_price AS intercept FROM (
      SELECT sku_root_id, {o.mean('g')} AS gradient, {o.mean(o.fixed('R2'))} AS R2, stddev_samp(gradient) AS std, count(DISTINCT store_id) AS store_count,
      min(cost_per_unit) AS cost_per_unit FROM {_STEEP} GROUP BY 1) a
    JOIN (SELECT sku_root_id, {o.mean('avg_sales_qty')} AS avg_qty, {o.mean('actual_price')} AS average_price FROM c_point GROUP BY 1) b USING (sku_root_id)))""")


def _group_sql(n: str, test: str) -> str:
    def mean(c: str) -> str:
        return o.mean(o.fixed(c), test)
    return f"""count(*) FILTER (WHERE {test}) AS n_{n}, {mean('gradient')} AS g_{n}, {mean('R2')} AS r_{n}, {mean('avg_price')} AS p_{n},
    {mean('cost_per_unit')} AS c_{n}, {mean('Nfactor')} AS f_{n}"""


def _groups_sql(literal: bool) -> str:
    opt = {n: o.ratio(f"1 - g_{n} * (p_{n} + c_{n})", f"-2 * g_{n}") for n in "as"}
    base = f"""SELECT *, {', '.join(f'{opt[n]} AS o_{n}, ({o.ratio(opt[n], f"p_{n}")} - 1) AS d_{n}, n_{n}::DOUBLE / total AS w_{n}' for n in 'as')} FROM (
      SELECT sku_root_id, {_group_sql('a', 'R2 >= 0.6' if literal else 'true')}, {_group_sql('s', 'R2 >= 0.6')} FROM c_sline WHERE points > 2 AND gradient < 0 GROUP BY 1)
      JOIN (SELECT sku_root_id, count(*) AS total FROM c_sline GROUP BY 1) USING (sku_root_id)"""
    pick = f"""SELECT *, CASE WHEN w_a > 0.1 AND w_s > 0.1 THEN CASE WHEN d_a <= 0.3 AND d_a < d_s THEN 'a' WHEN d_s <= 0.3 AND d_s < d_a THEN 's' WHEN d_a = d_s THEN 's' END
      WHEN w_a > 0.1 AND w_s < 0.1 AND d_a <= 0.3 THEN 'a' WHEN w_s > 0.1 AND w_a < 0.1 AND d_s <= 0.3 THEN 's' END AS pick FROM ({base})"""
    cols = {"avg_gradient": "g_{n}", "avg_R2": "r_{n}", "intercept": "f_{n} - g_{n} * p_{n}", "optimal_price": "o_{n}",
            "percentage_change": "d_{n}", "store_percentage": "w_{n}"}
    chosen = ", ".join(f"CASE pick WHEN 'a' THEN {e.format(n='a')} ELSE {e.format(n='s')} END AS {c}" for c, e in cols.items())
    return f"SELECT sku_root_id AS sku_id, {chosen} FROM ({pick}) WHERE pick IS NOT NULL"


for _lit in (False, True):
    add("d60_elasticity_groups" + ("_literal" if _lit else ""), on(lambda m, x=_lit: elasticity.sku_elasticity_groups(m["store_lines"], literal=x)),
        "sku_id avg_gradient:r avg_R2:r intercept:r optimal_price:r percentage_change:r store_percentage:r", _groups_sql(_lit))

_L1, _L2, _L3 = o.line("std_price_per_unit", "avg_sales_qty"), o.line("actual_price", "qn"), o.line("pn", "qn")
add("d61_pooled_elasticity", on(lambda m: elasticity.sku_pooled(m["price_points"], m["unit_cost"], min_weeks=1)),
    "sku_root_id coeficient:r intercept:r R2:r coeficient_std:r intercept_std:r R2_std:r max_price:d min_price:d store_count:i point_count:i cost_per_unit:d",
    f"""SELECT p.*, c.cost_per_unit FROM (SELECT sku_root_id, {_L2[0]} AS coeficient, {_L2[1]} AS intercept, {_L2[2]} AS R2, {_L3[0]} AS coeficient_std, {_L3[1]} AS intercept_std, {_L3[2]} AS R2_std,
    max(pn) AS max_price, min(pn) AS min_price, count(DISTINCT store_id) AS store_count, count(*) AS point_count FROM (
      SELECT *, {o.fixed(o.ratio('std_price_per_unit', "((sum(std_price_per_unit) OVER (PARTITION BY sku_root_id, store_id))::DOUBLE / count(*) OVER (PARTITION BY sku_root_id, store_id))"))} AS pn FROM (
        SELECT * FROM (SELECT *, (sum(qn) OVER (PARTITION BY sku_root_id))::DOUBLE / count(*) OVER (PARTITION BY sku_root_id) AS mid, stddev_samp(qn::DOUBLE) OVER (PARTITION BY sku_root_id) AS sd FROM (
          SELECT p.*, {o.fixed(o.ratio('avg_sales_qty', 'nf'))} AS qn FROM c_point p JOIN (
            SELECT sku_root_id, store_id, {_L1[0]} AS slope, {o.mean('avg_sales_qty')} AS nf FROM c_point WHERE duration_weeks >= 1 GROUP BY ALL HAVING count(*) > 2) f USING (sku_root_id, store_id)
          WHERE {o.ratio('slope', 'nf')} < 0 AND duration_weeks >= 1))
        WHERE sd IS NULL OR abs(qn::DOUBLE - mid) <= 2 * sd))
    GROUP BY 1 HAVING count(*) > 3) p LEFT JOIN c_cost c USING (sku_root_id)""")

# --- uplift -----------------------------------------------------------------

add("d62_active_period", mart("periods"), "sku_root_id store_id start_date end_date period:i", "c_period")
add("d63_daily_average", mart("per_day"), "sku_root_id store_id avg_sale_qty:d period:i", "c_perday")
add("d64_weekday_average", mart("per_weekday"), "sku_root_id store_id dayweek total_sale_qty:d period:i", "c_perweekday")
_BLN = ["bline_qty_all", "bline_qty_all_day"]
add("d65_attach_daily", on(lambda m: totals(m["daily_lined"], [_month(), "sku_root_id", "store_id"], ["total_sale_qty", *_BLN])),
    f"month sku_root_id store_id n_rows:i total_sale_qty:d {_d(_BLN)}",
    totals_sql("c_dlined", f"{_MONTH}, sku_root_id, store_id", ["total_sale_qty", *_BLN]))
add("d65_attach_promo", on(lambda m: totals(m["promo_lined"], ["date", "sku_root_id"], ["total_sale_qty", *_BLN])),
    f"date sku_root_id n_rows:i total_sale_qty:d {_d(_BLN)}", totals_sql("c_plined", "date, sku_root_id", ["total_sale_qty", *_BLN]))
add("d65_attach_post", on(lambda m: totals(m["post_lined"], ["date", "sku_root_id"], ["pf_sale_qty", *_BLN])),
    f"date sku_root_id n_rows:i pf_sale_qty:d {_d(_BLN)}", totals_sql("c_postlined", "date, sku_root_id", ["pf_sale_qty", *_BLN]))
add("d66_cumulative_distribution", mart("cume"), "sku_root_id store_id bline_qty_all:d cum_dist:d", "c_cume")
add("d67_filtered_daily", on(lambda m: totals(uplift.keep_pairs(m["daily_lined"], m["cume"]), ["sku_root_id", "store_id"], ["total_sale_qty"])),
    "sku_root_id store_id n_rows:i total_sale_qty:d",
    totals_sql("(SELECT * FROM c_dlined SEMI JOIN c_cume USING (sku_root_id, store_id))", "sku_root_id, store_id", ["total_sale_qty"]))
add("d67_filtered_promo", on(lambda m: totals(m["promo_kept"], ["promo_id", "sku_root_id", "store_id"], ["total_sale_qty", *_BLN])),
    f"promo_id sku_root_id store_id n_rows:i total_sale_qty:d {_d(_BLN)}", totals_sql("c_pkept", "promo_id, sku_root_id, store_id", ["total_sale_qty", *_BLN]))
add("d67_filtered_post", on(lambda m: totals(m["post_kept"], ["promo_id", "sku_root_id", "store_id"], ["pf_sale_qty", *_BLN])),
    f"promo_id sku_root_id store_id n_rows:i pf_sale_qty:d {_d(_BLN)}", totals_sql("c_postkept", "promo_id, sku_root_id, store_id", ["pf_sale_qty", *_BLN]))
add("d68_segment_residuals", on(lambda m: totals(uplift.segment_residuals(m["daily_lined"], m["root_sku"]), [_month(), "store_id", "segment"],
        ["total_sale_amt", "total_sale_qty", "residuals_bline_qty", "residuals_bline_qty_day", "promo_flag"])),
    "month store_id segment n_rows:i total_sale_amt:d total_sale_qty:d residuals_bline_qty:d residuals_bline_qty_day:d promo_flag:i",
    totals_sql("""(SELECT store_id, segment, date, sum(total_sale_amt) AS total_sale_amt, sum(total_sale_qty) AS total_sale_qty, max(promo_flag) AS promo_flag,
      sum(total_sale_qty) - sum(bline_qty_all) AS residuals_bline_qty, sum(total_sale_qty) - sum(bline_qty_all_day) AS residuals_bline_qty_day
      FROM c_dlined JOIN c_root USING (sku_root_id) GROUP BY ALL)""", f"{_MONTH}, store_id, segment",
      ["total_sale_amt", "total_sale_qty", "residuals_bline_qty", "residuals_bline_qty_day", "promo_flag"]))
_OF = "sku_root_id promo_mechanic promo_mechanic_description discount_depth discount_depth_rank:d"
_OFS = "sku_root_id, promo_mechanic, promo_mechanic_description, discount_depth, discount_depth_rank"
add("d69_uplift_profile", on(lambda m: uplift.uplift_profile(m["promo_kept"], m["campaign"])),
    f"{_OF} n_days_since_promo_start:i duration_week:i in_gondola_flag:i in_leaflet_flag:i sum_total_sale_qty:d sum_bline_qty_all_day:d sum_inc_sale_qty:d avg_perc_inc_sale_qty:d",
    f"""SELECT *, {o.ratio('sum_inc_sale_qty', 'sum_bline_qty_all_day')} AS avg_perc_inc_sale_qty FROM (
    SELECT {_OFS}, (date - start_date + 1)::INT AS n_days_since_promo_start, duration_week, in_gondola_flag, in_leaflet_flag, sum(total_sale_qty)::DECIMAL(18,6) AS sum_total_sale_qty,
    sum(bline_qty_all_day)::DECIMAL(18,6) AS sum_bline_qty_all_day, sum(total_sale_qty - bline_qty_all_day)::DECIMAL(18,6) AS sum_inc_sale_qty
    FROM c_pkept JOIN c_wk USING (promo_id, promo_year) GROUP BY ALL)""")


def _post_sql(src: str, extra: str = "") -> str:
    gain = "(pf_sale_qty - bline_qty_all_day)::DECIMAL(18,6)"
    return f"""SELECT *{extra} FROM (SELECT {_OFS}, (date - end_date + 1)::INT AS n_days_since_promo_end, duration_week, in_gondola_flag,
    sum(pf_sale_qty)::DECIMAL(18,6) AS sum_pf_sale_qty, sum(bline_qty_all_day)::DECIMAL(18,6) AS sum_bline_qty_all_day, sum({gain})::DECIMAL(18,6) AS sum_inc_pf_sale_qty,
    {o.mean('pf_sale_qty')} AS avg_pf_sale_qty, {o.mean('bline_qty_all_day')} AS avg_bline_qty_all_day, {o.mean(gain)} AS avg_inc_pf_sale_qty,
    {o.mean(o.fixed(o.ratio(gain, 'bline_qty_all_day')))} AS avg_perc_inc_sale_qty FROM {src} JOIN c_wk USING (promo_id, promo_year) GROUP BY ALL)"""


_POST = (f"{_OF} n_days_since_promo_end:i duration_week:i in_gondola_flag:i sum_pf_sale_qty:d sum_bline_qty_all_day:d sum_inc_pf_sale_qty:d "
         "avg_pf_sale_qty:d avg_bline_qty_all_day:d avg_inc_pf_sale_qty:d avg_perc_inc_sale_qty:d")
add("d70_post_promo_profile", on(lambda m: uplift.post_profile(m["post_kept"], m["campaign"])), _POST, _post_sql("c_postkept"))
add("d71_post_promo_profile_excluded", on(lambda m: uplift.post_profile(m["post_kept"], m["campaign"], exclude_repromoted=True)), _POST + " perc_inc_sale_qty:d",
    _post_sql("(SELECT * FROM c_postkept ANTI JOIN (SELECT DISTINCT sku_root_id, store_id FROM c_postkept WHERE pf_promo_flag = 1) USING (sku_root_id, store_id))",
              f", {o.ratio('sum_inc_pf_sale_qty', 'sum_bline_qty_all_day')} AS perc_inc_sale_qty"))
add("d71_post_promo_profile_excluded_by_year", on(lambda m: uplift.post_profile(m["post_kept"], m["campaign"], exclude_repromoted=True, within=["promo_year"])), _POST + " perc_inc_sale_qty:d",
    _post_sql("(SELECT * FROM c_postkept ANTI JOIN (SELECT DISTINCT sku_root_id, store_id, promo_year FROM c_postkept WHERE pf_promo_flag = 1) USING (sku_root_id, store_id, promo_year))",
              f", {o.ratio('sum_inc_pf_sale_qty', 'sum_bline_qty_all_day')} AS perc_inc_sale_qty"))
add("d72_coverage", on(lambda m: uplift.coverage(m["daily"], m["periods"])), "total_sale_amt:d total_sale_qty:d",
    "SELECT sum(total_sale_amt) AS total_sale_amt, sum(total_sale_qty) AS total_sale_qty FROM c_daily SEMI JOIN (SELECT * FROM c_period WHERE period > 700) USING (sku_root_id, store_id)")
_PTOT = [*_AL, "total_counterfactual_qty", "total_inc_qty", "perc_inc_qty", "duration_wks"]
add("d73_aggregate_promo_to_sku", mart("promo_totals"),
    f"{_PKS} promo_mechanic_description discount_depth_rank:d in_leaflet_flag:i in_gondola_flag:i promo_prev_week:i promo_pf_week:i {_d(_PTOT)}", "c_ptotals")
add("d74_example_categories", on(lambda m: uplift.example_categories(
        facts.with_root(m["promo_totals"], m["root_sku"], ["area", "section", "category"]), ["AREA_0", "AREA_1"], ["SECTION_0", "SECTION_1"], ["CATEGORY_0", "CATEGORY_1"], ["10", "20"])),
    f"{_PKS} area section category perc_inc_qty:d",
    """SELECT t.*, area, section, category FROM c_ptotals t JOIN c_root r USING (sku_root_id) WHERE area IN ('AREA_0', 'AREA_1') AND section IN ('SECTION_0', 'SECTION_1')
    AND category IN ('CATEGORY_0', 'CATEGORY_1') AND promo_mechanic IN ('10', '20') AND discount_depth IS NOT NULL""")

# --- prediction -------------------------------------------------------------

_TK = ("sku_root_id, promo_id, promo_year, promo_mechanic, promo_mechanic_description, discount_depth, discount_depth_rank, "
       + ", ".join(training.STORE_COUNTS) + ", " + ", ".join(training.DISPLAY))
_LABEL = "coalesce(own_brand_label, CASE wealthy_range_flag WHEN 'N' THEN 'Normal' WHEN 'S' THEN 'Premium' END)"
_ABOUT = (", c.start_date, (c.end_date - c.start_date + 1)::INT AS duration_days, c.customer_profile_type, dayname(c.start_date) AS campaign_start_day, "
          "CASE WHEN month(c.start_date) = 9 THEN 'Sept' ELSE strftime(c.start_date, '%b') END AS campaign_start_month, week(c.start_date) AS campaign_start_week, "
          f"r.description, r.area, r.section, r.category, r.subcategory, r.segment, r.brand_name, r.flag_healthy, {_LABEL} AS brand_price_label, "
          "x.promo_mechanic_description AS Promo_mechanic_en FROM ({src}) x "
          "JOIN c_campaign c ON c.promo_id = x.promo_id AND c.promo_year::VARCHAR = x.promo_year JOIN c_root r ON r.sku_root_id = x.sku_root_id")
_TSUM = f"""SELECT {_TK}, {o.mean(o.fixed('avg_store_size'))} AS avg_store_size, max(includes_weekend) AS includes_weekend,
  {', '.join(f'sum({c})::DECIMAL(18,6) AS {n}' for n, c in training.SUMS.items())}
  FROM c_bp WHERE promo_mechanic IN ('10', '20') AND change_flag IN (1, 2) GROUP BY ALL"""
_PEXT = {
    "c_train": f"SELECT x.*, {', '.join(f'{o.ratio(a, b)} AS {n}' for n, (a, b) in training.RATIOS.items())}" + _ABOUT.format(src=_TSUM),
    "c_posttrain": "SELECT x.*" + _ABOUT.format(src=f"""SELECT sku_root_id, promo_id, promo_year, promo_mechanic, promo_mechanic_description, discount_depth, discount_depth_rank,
      no_impacted_stores, no_impacted_regions, {', '.join(training.DISPLAY)}, {o.mean(o.fixed('avg_store_size'))} AS avg_store_size, max(includes_weekend) AS includes_weekend,
      {', '.join(f'sum({training.SUMS[n]})::DECIMAL(18,6) AS {n}' for n in list(training.SUMS)[:10])},
      {', '.join(f'{o.mean(o.fixed(o.ratio(a, b)))} AS {n}' for n, a, b in (('pct_inc_sale', 'inc_sale_amt', 'sale_amt_bl'), ('pct_inc_qty', 'inc_sale_qty', 'sale_qty_bl'), ('pct_inc_margin', 'inc_margin_amt', 'margin_amt_bl')))}
      FROM c_bp WHERE promo_mechanic IN ('10', '20') AND change_flag = 3 GROUP BY ALL""") + " WHERE x.pct_inc_sale IS NOT NULL",
    "c_usual": f"SELECT sku_root_id, {o.mean('total_sale_qty')} * 100 * 2 AS p_qty_bl FROM c_weekly WHERE promo_flag = 0 GROUP BY 1",
    "c_score": f"""SELECT r.sku_root_id, r.description, r.area, r.section, r.category, r.subcategory, r.segment, r.brand_name, r.flag_healthy, r.innovation_flag, r.tourism_flag, r.local_flag,
      r.regional_flag, {_LABEL} AS brand_price_label, 50 AS no_hipermercados_stores, 0 AS no_other_stores, 100 AS no_impacted_stores, 14 AS duration_days, 'Jan' AS campaign_start_month, true AS includes_weekend,
      q.p_qty_bl, d.*, p.promoted_in_past FROM c_root r CROSS JOIN (SELECT DISTINCT promo_mechanic, Promo_mechanic_en, discount_depth, discount_depth_rank FROM c_train) d
      LEFT JOIN c_usual q ON q.sku_root_id = r.sku_root_id
      LEFT JOIN (SELECT DISTINCT sku_root_id, discount_depth, 1 AS promoted_in_past FROM c_train) p ON p.sku_root_id = r.sku_root_id AND p.discount_depth = d.discount_depth""",
}
_TN = " ".join([_d(training.SUMS), _d(training.RATIOS)])
_TS = ("sku_root_id promo_id promo_year promo_mechanic Promo_mechanic_en discount_depth discount_depth_rank:d start_date duration_days:i campaign_start_day campaign_start_month "
       "campaign_start_week:i area section category subcategory segment brand_name brand_price_label includes_weekend avg_store_size:d no_impacted_stores:i in_leaflet_flag:i")
add("d75_training_table", mart("train"), f"{_TS} {_TN}", "c_train", extra=_PEXT)
add("d76_post_training_table", mart("post_train"), f"{_TS} {_d(list(training.SUMS)[:10])} pct_inc_sale:d pct_inc_qty:d pct_inc_margin:d", "c_posttrain", extra=_PEXT)
_SCORE = ("sku_root_id description area section category subcategory segment brand_name brand_price_label flag_healthy no_hipermercados_stores:i no_other_stores:i no_impacted_stores:i "
          "duration_days:i campaign_start_month includes_weekend p_qty_bl:d promo_mechanic Promo_mechanic_en discount_depth discount_depth_rank:d promoted_in_past:i")
add("d77_scoring_table", mart("score"), _SCORE, "c_score", extra=_PEXT)
add("d77_post_scoring_table", on(lambda m: training.post_score_table(m["root_sku"], m["train"], _given_fit(m))),
    "sku_root_id segment brand_price_label duration_days:i includes_weekend p_qty_bl:d promo_mechanic Promo_mechanic_en discount_depth promoted_in_past:i",
    f"""SELECT r.sku_root_id, r.segment, {_LABEL} AS brand_price_label, 14 AS duration_days, false AS includes_weekend, f.avg_forecast_period AS p_qty_bl, d.*, p.promoted_in_past
    FROM c_root r JOIN (SELECT * FROM c_given WHERE metric = 'pred_counterfactual_sale_qty') f USING (sku_root_id)
    CROSS JOIN (SELECT DISTINCT promo_mechanic, Promo_mechanic_en, discount_depth FROM c_train) d
    LEFT JOIN (SELECT DISTINCT sku_root_id, discount_depth, 1 AS promoted_in_past FROM c_train) p ON p.sku_root_id = r.sku_root_id AND p.discount_depth = d.discount_depth""",
    extra={**_PEXT, **_FEX, **_FIT_SQL}, recursive={"c_run"})

# Models: the target is the relative uplift of the promotion.
_TARGET = "p_cal_perc_inc_sale_qty"
_FEATURES = ["category", "segment", "brand_name", "no_hipermercados_stores", "no_supermercados_stores", "Promo_mechanic_en", "duration_days",
             "campaign_start_month", "campaign_start_week", "discount_depth", "in_leaflet_flag", "in_gondola_flag"]
_CATS = ["category", "segment", "brand_name", "Promo_mechanic_en", "campaign_start_month", "discount_depth"]
_KEYS = ["sku_root_id", "promo_id", "promo_year", "promo_mechanic"]
_DEPTHS = "(" + ", ".join(f"'{d}'" for d in models.ALLOWED_DEPTHS) + ")"


def _clean(m: Mart) -> DataFrame:
    if not hasattr(m, "_cleaned"):
        rules = models.Rules(excluded_months=models.EXCLUDED_MONTHS, min_stores=1, max_days=30, outliers="positive")
        m._cleaned = m.space.keep(models.clean(m["train"], _FEATURES, _TARGET, rules, keep=_KEYS), "cleaned")
    return m._cleaned


def _clean_capped(m: Mart) -> DataFrame:
    rules = models.Rules(max_days=40, outliers="capped")
    return models.clean(m["train"], ["subcategory", "segment", "brand_name", "discount_depth_rank", "duration_days"], _TARGET, rules, keep=_KEYS)


def _clean_small_base(m: Mart) -> DataFrame:
    wide = facts.with_root(m["promo_totals"], m["root_sku"], ["category", "subcategory", "segment"])
    wide = wide.withColumn("promo_mechanic_dd", F.concat("promo_mechanic", F.lit("-"), "discount_depth"))
    names = ["category", "subcategory", "segment", "sku_root_id", "promo_mechanic_dd", "duration_wks", "in_gondola_flag", "in_leaflet_flag"]
    return models.clean(wide.where(F.col("perc_inc_qty").isNotNull()), names, "perc_inc_qty", models.Rules(depths=None, outliers="small_base"), keep=["promo_id"])


_COND = f"no_impacted_stores >= 1 AND discount_depth IN {_DEPTHS} AND {_TARGET} > 0"
_MEX = {
    **_PEXT,
    "c_clean0": f"SELECT * FROM c_train WHERE campaign_start_month NOT IN ('Jan', 'Aug', 'Nov', 'Dec') AND duration_days <= 30 AND {_COND}",
    "c_clean": f"SELECT * FROM c_clean0 WHERE {_TARGET} < (SELECT quantile_cont({_TARGET}, 0.95) FROM c_clean0)",
    "c_capped0": f"SELECT * FROM c_train WHERE duration_days <= 40 AND {_COND} AND {_TARGET} < 10",
    "c_capped": f"SELECT * FROM c_capped0 WHERE {_TARGET} < (SELECT quantile_cont({_TARGET}, 0.95) FROM c_capped0)",
    "c_small0": """SELECT promo_id, sku_root_id, category, subcategory, segment, promo_mechanic || '-' || discount_depth AS promo_mechanic_dd, duration_wks - 2 AS duration_wks, in_gondola_flag, in_leaflet_flag,
      greatest(perc_inc_qty, 0) AS perc_inc_qty FROM c_ptotals JOIN c_root r USING (sku_root_id)
      WHERE perc_inc_qty IS NOT NULL AND (perc_inc_qty > 0 OR total_counterfactual_qty > 100) AND perc_inc_qty < 10""",
    "c_small": "SELECT * FROM c_small0 WHERE perc_inc_qty < (SELECT quantile_cont(perc_inc_qty, 0.95) FROM c_small0)",
    "c_codes": " UNION ALL ".join(f"SELECT '{c}' AS feature, value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {c} AS value FROM c_clean)" for c in _CATS),
    "c_split": f"""SELECT *, ('0x' || substring(md5({" || '|' || ".join(_KEYS)} || '|' || discount_depth), 1, 8))::BIGINT % 10 AS bucket FROM c_clean""",
    "c_gm": f"SELECT category, discount_depth, {o.mean(o.fixed(_TARGET))} AS prediction FROM c_split WHERE bucket < 8 GROUP BY ALL",
    "c_valid2": "SELECT s.*, g.prediction FROM c_split s LEFT JOIN c_gm g USING (category, discount_depth) WHERE bucket >= 8",
}
add("d78_clean_training", on(_clean), " ".join(_KEYS) + f" discount_depth segment brand_name campaign_start_month duration_days:i {_TARGET}:d", "c_clean", extra=_MEX)
add("d78_clean_capped", on(_clean_capped), " ".join(_KEYS) + f" subcategory discount_depth_rank:d {_TARGET}:d", "c_capped", extra=_MEX)
add("d78_clean_small_base", on(_clean_small_base), "promo_id sku_root_id promo_mechanic_dd duration_wks:d in_gondola_flag:i perc_inc_qty:d", "c_small", extra=_MEX)
add("d78_clean_post", on(lambda m: models.clean(m["post_train"], ["segment", "discount_depth_rank"], "pct_inc_qty",
        models.Rules(max_days=40, outliers="negative", drop_missing_target=True), keep=_KEYS)),
    " ".join(_KEYS) + " segment discount_depth_rank:d pct_inc_qty:d",
    f"SELECT * REPLACE (CASE WHEN pct_inc_qty > 0 THEN 0 ELSE pct_inc_qty END AS pct_inc_qty) FROM c_posttrain WHERE no_impacted_stores >= 1 AND duration_days <= 40 AND discount_depth IN {_DEPTHS} AND pct_inc_qty IS NOT NULL", extra=_MEX)
add("d79_category_codes", on(lambda m: models.category_codes(_clean(m), _CATS)), "feature value code:i", "c_codes", extra=_MEX)
add("d79_encoded_training", on(lambda m: models.encode(_clean(m), models.category_codes(_clean(m), ["segment", "discount_depth"]), ["segment", "discount_depth"])),
    " ".join(_KEYS) + " segment:i discount_depth:i",
    """SELECT c.* REPLACE (a.code AS segment, b.code AS discount_depth) FROM c_clean c
    LEFT JOIN c_codes a ON a.feature = 'segment' AND a.value = c.segment LEFT JOIN c_codes b ON b.feature = 'discount_depth' AND b.value = c.discount_depth""", extra=_MEX)


def _split(m: Mart) -> tuple[DataFrame, DataFrame]:
    key = F.concat_ws("|", *_KEYS, "discount_depth")
    return models.split(_clean(m), key)


add("d80_train_split", on(lambda m: _split(m)[0]), " ".join(_KEYS) + " discount_depth", "SELECT * FROM c_split WHERE bucket < 8", extra=_MEX)
add("d80_validation_split", on(lambda m: _split(m)[1]), " ".join(_KEYS) + " discount_depth", "SELECT * FROM c_split WHERE bucket >= 8", extra=_MEX)


# The most rounds; the error of the validation rows ends boosting before.
TREE_ROUNDS = 100


def _trees(m: Mart):
    if not hasattr(m, "_tree_model"):
        train, valid = _split(m)
        m._tree_model = models.fit_trees(train, _FEATURES, _CATS, _TARGET, rounds=TREE_ROUNDS, depth=5, validation=valid)
    return m._tree_model


def _tree_validation(m: Mart) -> DataFrame:
    return models.predict(_trees(m), _split(m)[1], _FEATURES, _CATS)


def _means(m: Mart) -> tuple[DataFrame, DataFrame]:
    train, valid = _split(m)
    means = models.group_mean(train, ["category", "discount_depth"], _TARGET)
    return means, models.apply_group_mean(valid, means, ["category", "discount_depth"])


add("d81_boosted_trees", on(_tree_validation), " ".join(_KEYS) + f" {_TARGET}:d prediction:d")
# Leaf-wise boosting on ordered target statistics: the codes, the ranges with their sums and the first split as SQL.
_LEAFWISE = Settings(rounds=30, leaves=15, rate=0.15, bins=64, patience=5)
_ROWKEY = [*_KEYS, "discount_depth"]
_CODED = [c for c in _CATS if c not in _ROWKEY]


def _prepared(m: Mart) -> boosting.Prepared:
    if not hasattr(m, "_ranges"):
        train, valid = _split(m)
        m._ranges = boosting.prepare(train, valid, _FEATURES, _CATS, _TARGET, _ROWKEY, _LEAFWISE, Workspace(m.spark))
    return m._ranges


def _leafwise(m: Mart) -> boosting.Booster:
    if not hasattr(m, "_leaf_model"):
        train, valid = _split(m)
        m._leaf_model = boosting.fit(train, valid, _FEATURES, _CATS, _TARGET, _ROWKEY, _LEAFWISE)
    return m._leaf_model


def _leaf_validation(m: Mart) -> DataFrame:
    return boosting.predict(_leafwise(m), _split(m)[1])


_MARK = "md5('42|' || " + " || '|' || ".join(_ROWKEY) + ")"
_LEX = {
    **_MEX,
    "c_marked": f"SELECT *, {_MARK} AS mk, {o.fixed(_TARGET)} AS fy FROM c_split WHERE bucket < 8",
    "c_base": f"SELECT {o.mean(o.fixed(_TARGET))} AS prior FROM c_split WHERE bucket < 8",
    "c_coded": " UNION ALL ".join(
        f"""SELECT {', '.join(_ROWKEY)}, '{c}' AS feature, (coalesce(sum(fy) OVER w, 0)::DOUBLE + p.prior) / (count(*) OVER w + 1) AS x, {_TARGET}::DOUBLE AS y, p.prior FROM c_marked, c_base p
        WINDOW w AS (PARTITION BY {c} ORDER BY mk, fy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""" if c in _CATS else
        f"SELECT {', '.join(_ROWKEY)}, '{c}', {c}::DOUBLE, {_TARGET}::DOUBLE, p.prior FROM c_marked, c_base p" for c in _FEATURES),
    "c_at": "SELECT *, (rank() OVER (PARTITION BY feature ORDER BY x) - 1) * 64 // count(*) OVER (PARTITION BY feature) AS cell FROM c_coded",
    "c_ranges": "SELECT feature, range, min(x) AS low, count(*) AS n, sum(y - prior) AS total FROM (SELECT *, dense_rank() OVER (PARTITION BY feature ORDER BY cell) AS range FROM c_at) GROUP BY ALL",
}
add("d79_target_statistics", on(lambda m: target_codes.ordered_codes(_split(m)[0].select(*_ROWKEY, *_CODED, _TARGET), _CODED, _TARGET, F.md5(F.concat_ws("|", F.lit(42), *_ROWKEY)))
        .unpivot(_ROWKEY, _CODED, "feature", "x")),
    " ".join(_ROWKEY) + " feature x:d", f"SELECT * FROM c_coded WHERE feature IN ({', '.join(repr(c) for c in _CODED)})", extra=_LEX)
add("d81_root_histogram", on(lambda m: boosting.root_histogram(_prepared(m), _FEATURES)), "feature range:i n:i total:r", "c_ranges", extra=_LEX)
add("d81_first_split", on(lambda m: boosting.first_split(_prepared(m), _FEATURES, _LEAFWISE)), "feature low:d n_left:i sum_left:r",
    f"""SELECT feature, low, n_left, sum_left FROM (
      SELECT feature, range, lead(low) OVER w AS low, sum(n) OVER w AS n_left, sum(total) OVER w AS sum_left, sum(n) OVER f AS n, sum(total) OVER f AS total, list_position([{', '.join(repr(c) for c in _FEATURES)}], feature) AS place
      FROM c_ranges WINDOW w AS (PARTITION BY feature ORDER BY range), f AS (PARTITION BY feature))
    WHERE n_left >= 20 AND n - n_left >= 20
    ORDER BY round(sum_left * sum_left / (n_left + 1) + (total - sum_left) * (total - sum_left) / (n - n_left + 1) - total * total / (n + 1), 6) DESC, place, range LIMIT 1""", extra=_LEX)
add("d81_leafwise_trees", on(_leaf_validation), " ".join(_ROWKEY) + f" {_TARGET}:d prediction:d")
add("d81_leafwise_rows", on(lambda m: _leaf_validation(m).select(*_ROWKEY, _TARGET, F.col("prediction").isNotNull().alias("scored"))),
    " ".join(_ROWKEY) + f" {_TARGET}:d scored", "SELECT *, TRUE AS scored FROM c_split WHERE bucket >= 8", extra=_MEX)
add("d82_leafwise_evaluation", on(lambda m: models.evaluate(_leaf_validation(m), _TARGET)), "n:i rmse:r mean_error:r mae:r mape:r benchmark_std:r benchmark_mean_error:r benchmark_mae:r")
# What holds for any fit: every row of the validation part has a prediction.
add("d81_scored_rows", on(lambda m: _tree_validation(m).select(*_KEYS, "discount_depth", _TARGET, F.col("prediction").isNotNull().alias("scored"))),
    " ".join(_KEYS) + f" discount_depth {_TARGET}:d scored", "SELECT *, TRUE AS scored FROM c_split WHERE bucket >= 8", extra=_MEX)
add("d82_tree_evaluation", on(lambda m: models.evaluate(_tree_validation(m), _TARGET)), "n:i rmse:r mean_error:r mae:r mape:r benchmark_std:r benchmark_mean_error:r benchmark_mae:r")
_ERR = f"({_TARGET} - prediction)"
add("d82_model_evaluation", on(lambda m: models.evaluate(_means(m)[1], _TARGET)),
    "n:i rmse:r mean_error:r mae:r mape:r benchmark_std:r benchmark_mean_error:r benchmark_mae:r",
    f"""SELECT count(*) AS n, sqrt({o.mean(o.fixed(_ERR + ' * ' + _ERR))}) AS rmse, {o.mean(o.fixed(_ERR))} AS mean_error, median(abs({_ERR})) AS mae,
    median(coalesce(abs({o.ratio(_ERR, _TARGET)}), 0)) AS mape, stddev_pop({o.fixed(_TARGET)}::DOUBLE) AS benchmark_std, {o.mean(o.fixed(_TARGET))} AS benchmark_mean_error,
    {o.mean(o.fixed(f'abs({_TARGET})'))} AS benchmark_mae FROM c_valid2""", extra=_MEX)
add("d83_group_mean_model", on(lambda m: _means(m)[1]), " ".join(_KEYS) + f" category discount_depth {_TARGET}:d prediction:d", "c_valid2", extra=_MEX)

# Grouped least squares with one regressor, so that SQL can state the same minimum-norm solution.
_LV = ols.LEVELS
_LX = {
    **_MEX,
    "c_lrows": " UNION ALL ".join(
        f"SELECT {i} AS rank, '{','.join(f)}' AS agg_fields, {' || chr(1) || '.join(f)} AS gkey, discount_depth_rank::DOUBLE AS x, {_TARGET}::DOUBLE AS y FROM c_capped"
        for i, f in enumerate(_LV, 1)),
    "c_ltrim": "SELECT l.*, l.y < q.lim AS ok FROM c_lrows l JOIN (SELECT rank, gkey, quantile_cont(y, 0.95) AS lim FROM c_lrows GROUP BY ALL) q USING (rank, gkey)",
    "c_lfit": """SELECT rank, agg_fields, gkey, n, skipped, CASE WHEN n >= 3 THEN CASE WHEN flat THEN x0 * my / (1 + x0 * x0) ELSE s END END AS slope,
      CASE WHEN n >= 3 THEN CASE WHEN flat THEN my / (1 + x0 * x0) ELSE c END END AS const, CASE WHEN n >= 3 THEN CASE WHEN flat THEN 0 ELSE r2 END END AS r2 FROM (
      SELECT rank, agg_fields, gkey, count(*) FILTER (WHERE ok) AS n, count(*) FILTER (WHERE NOT ok) AS skipped, min(x) FILTER (WHERE ok) = max(x) FILTER (WHERE ok) AS flat,
      max(x) FILTER (WHERE ok) AS x0, avg(y) FILTER (WHERE ok) AS my, regr_slope(y, x) FILTER (WHERE ok) AS s, regr_intercept(y, x) FILTER (WHERE ok) AS c, regr_r2(y, x) FILTER (WHERE ok) AS r2
      FROM c_ltrim GROUP BY ALL)""",
    "c_lerr": f"""SELECT rank, gkey, sqrt({o.mean(o.fixed('e * e'))}) AS rmse, {o.mean(o.fixed('e'))} AS mean_error, median(abs(e)) AS mae, median(coalesce(abs({o.ratio('e', 'y')}), 0)) AS mape
      FROM (SELECT t.rank, t.gkey, t.y, t.y - (f.const + f.slope * t.x) AS e FROM c_ltrim t JOIN c_lfit f USING (rank, gkey) WHERE ok AND f.n >= 3) GROUP BY ALL""",
    "c_lmodel": "SELECT f.*, e.rmse, e.mean_error, e.mae, e.mape FROM c_lfit f LEFT JOIN c_lerr e USING (rank, gkey)",
    "c_lbest": f"""SELECT * FROM (SELECT k.*, m.rank, m.gkey, m.n AS no_data_points, m.r2, m.rmse, m.mean_error, m.mae, m.mape, m.const AS coeff_const, m.slope AS coeff_depth,
      row_number() OVER (PARTITION BY k.subcategory, k.brand_name, k.segment ORDER BY CASE WHEN round(m.r2, 9) >= 0.2 THEN 0 ELSE 1 END, m.mape, m.rank) AS rn
      FROM (SELECT DISTINCT subcategory, brand_name, segment FROM c_capped) k JOIN c_lmodel m ON m.rmse IS NOT NULL AND ({' OR '.join(
          f"(m.rank = {i} AND m.gkey = {' || chr(1) || '.join('k.' + c for c in f)})" for i, f in enumerate(_LV, 1))})) WHERE rn = 1""",
}


def _joined_key(df: DataFrame) -> DataFrame:
    return df.withColumn("gkey", F.array_join("key", "\u0001"))


def _ols(m: Mart) -> DataFrame:
    if not hasattr(m, "_ols_models"):
        made = ols.grouped_ols(_clean_capped(m), _LV, ["discount_depth_rank"], _TARGET, names={"discount_depth_rank": "depth"})
        m._ols_models = m.space.keep(made, "ols_models")
    return m._ols_models


def _best(m: Mart) -> DataFrame:
    return ols.best_model(_clean_capped(m), _ols(m), _LV)


add("d84_grouped_ols", on(lambda m: _joined_key(_ols(m)).withColumns({
        "slope": F.col("coeff_depth"), "const": F.col("coeff_const"), "n": F.col("no_data_points"), "skipped": F.col("outlier_data_points")})),
    "rank:i agg_fields gkey n:i skipped:i slope:r const:r rmse:r mean_error:r mae:r mape:r", "c_lmodel", extra=_LX)
add("d84_grouped_ols_full", on(lambda m: _joined_key(ols.grouped_ols(_clean_capped(m), _LV, ["discount_depth_rank", "duration_days"], _TARGET))),
    "rank:i agg_fields gkey no_data_points:i outlier_data_points:i r2:r rmse:r mae:r mape:r coeff_const:r coeff_discount_depth_rank:r coeff_duration_days:r")
# Groups of full rank with two regressors have one solution, which SQL states by determinants.
_L2X = {
    **_LX,
    "c_l2rows": " UNION ALL ".join(
        f"SELECT {i} AS rank, {' || chr(1) || '.join(f)} AS gkey, discount_depth_rank::DOUBLE AS a, duration_days::DOUBLE AS b, {_TARGET}::DOUBLE AS y FROM c_capped"
        for i, f in enumerate(_LV, 1)),
    "c_l2sums": """SELECT rank, gkey, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(y) AS yy, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy
      FROM c_l2rows JOIN (SELECT rank, gkey, quantile_cont(y, 0.95) AS lim FROM c_l2rows GROUP BY ALL) USING (rank, gkey) WHERE y < lim GROUP BY ALL""",
    "c_l2fit": """SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS sa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS sb FROM c_l2sums
      WHERE n >= 3 AND aa > 1e-12 AND bb > 1e-12 AND 1 - ab * ab / (aa * bb) > 1e-9""",
}
add("d84_grouped_ols_two", on(lambda m: _joined_key(ols.grouped_ols(_clean_capped(m), _LV, ["discount_depth_rank", "duration_days"], _TARGET)).where(
        (F.col("vif_duration_days") < 1e9)).select("rank", "gkey", F.col("no_data_points").alias("n"), *[(F.round(c, 4) + 0.0).alias(n) for c, n in (
            ("coeff_discount_depth_rank", "sa"), ("coeff_duration_days", "sb"), ("coeff_const", "c"), ("r2", "r2"), ("vif_duration_days", "vif"))])),
    "rank:i gkey n:i sa:d sb:d c:d r2:d vif:d",
    """SELECT rank, gkey, n, round(sa, 4) + 0.0 AS sa, round(sb, 4) + 0.0 AS sb, round(my - sa * ma - sb * mb, 4) + 0.0 AS c, CASE WHEN yy > 0 THEN round((sa * ay + sb * byy) / yy, 4) + 0.0 END AS r2,
    round(1 / (1 - ab * ab / (aa * bb)), 4) AS vif FROM c_l2fit""", extra=_L2X)
add("d84_grouped_ols_by_category", on(lambda m: _joined_key(ols.grouped_ols(
        models.clean(m["train"], ["category", "subcategory", "segment", "brand_name", "discount_depth_rank"], _TARGET, models.Rules(max_days=40, outliers="capped")),
        ols.LEVELS_BY_CATEGORY, ["discount_depth_rank"], _TARGET)).groupBy("rank", "agg_fields").agg(
            F.count(F.lit(1)).alias("groups"), F.sum("no_data_points").alias("points"), F.sum("outlier_data_points").alias("skipped"))),
    "rank:i agg_fields groups:i points:i skipped:i",
    "SELECT rank, agg_fields, count(*) AS groups, sum(n) AS points, sum(skipped) AS skipped FROM c_lfit GROUP BY ALL",
    extra={**_LX, "c_lrows": " UNION ALL ".join(
        f"SELECT {i} AS rank, '{','.join(f)}' AS agg_fields, {' || chr(1) || '.join(f)} AS gkey, discount_depth_rank::DOUBLE AS x, {_TARGET}::DOUBLE AS y FROM c_capped"
        for i, f in enumerate(ols.LEVELS_BY_CATEGORY, 1))})
_BESTS = "subcategory brand_name segment rank:i no_data_points:i rmse:r mae:r mape:r coeff_const:r coeff_depth:r"
add("d85_best_model", on(_best), _BESTS, "c_lbest", extra=_LX)


def _mechanic_ols(m: Mart) -> DataFrame:
    if not hasattr(m, "_mechanic_models"):
        made = ols.grouped_ols(_clean_small_base(m), ols.LEVELS_BY_MECHANIC, ["duration_wks", "in_gondola_flag", "in_leaflet_flag"], "perc_inc_qty",
                               min_rows=2, trim_q=None, names={"duration_wks": "duration", "in_gondola_flag": "in_gondola", "in_leaflet_flag": "in_leaflet"})
        m._mechanic_models = m.space.keep(made, "mechanic_models")
    return m._mechanic_models


_TERMS = ["const", "duration", "in_gondola", "in_leaflet"]
add("d86_mechanic_ols", on(lambda m: _joined_key(_mechanic_ols(m))),
    "rank:i agg_fields gkey no_data_points:i r2:r rmse:r mean_error:r mae:r mape:r f_prob:r " + " ".join(f"{p}_{t}:r" for t in _TERMS for p in ("coeff", "p_coeff", "vif")))
_VX = {**_MEX, "c_v2": " UNION ALL ".join(
    f"SELECT {i} AS rank, {' || chr(1) || '.join(f)} AS gkey, count(*) AS n FROM c_small GROUP BY ALL HAVING count(*) >= 2" for i, f in enumerate(ols.LEVELS_BY_MECHANIC, 1))}
add("d87_model_by_samples", on(lambda m: _joined_key(ols.best_model_by_samples(_clean_small_base(m), _mechanic_ols(m), ols.LEVELS_BY_MECHANIC))),
    "sku_root_id segment subcategory category promo_mechanic_dd valid_dp rank:i gkey no_data_points:i",
    f"""SELECT * FROM (SELECT k.*, m.rank, m.gkey, m.n AS no_data_points, max(m.n >= 15) OVER (PARTITION BY sku_root_id, promo_mechanic_dd, segment, subcategory, category) AS valid_dp,
    row_number() OVER (PARTITION BY sku_root_id, promo_mechanic_dd, segment, subcategory, category ORDER BY CASE WHEN m.n >= 15 THEN 0 ELSE 1 END, m.rank) AS rn
    FROM (SELECT DISTINCT sku_root_id, segment, subcategory, category, promo_mechanic_dd FROM c_small) k JOIN c_v2 m ON {' OR '.join(
        f"(m.rank = {i} AND m.gkey = {' || chr(1) || '.join('k.' + c for c in f)})" for i, f in enumerate(ols.LEVELS_BY_MECHANIC, 1))}) WHERE rn = 1""", extra=_VX)
add("d88_model_statistics", on(lambda m: ols.model_stats(_best(m))), "rmse:r mean_error:r mae:r mape:r mae_std:r mape_std:r",
    f"""SELECT {o.mean(o.fixed('rmse'))} AS rmse, {o.mean(o.fixed('mean_error'))} AS mean_error, median(mae) AS mae, median(mape) AS mape,
    stddev_samp(mae) AS mae_std, stddev_samp(mape) AS mape_std FROM c_lbest""", extra=_LX)


def _ols_scores(m: Mart) -> DataFrame:
    skus = m["root_sku"].select("sku_root_id", "subcategory", "brand_name", "segment")
    depths = m["train"].select("discount_depth", "discount_depth_rank").distinct()
    return ols.score_ols(skus, depths, _best(m), ols.all_keys(_LV), ["discount_depth_rank"], {"discount_depth_rank": "depth"})


add("d89_regression_scores", on(_ols_scores), "sku_root_id discount_depth rank:i prediction:r",
    """SELECT r.sku_root_id, d.discount_depth, b.rank, b.coeff_const + b.coeff_depth * d.discount_depth_rank::DOUBLE AS prediction
    FROM c_root r CROSS JOIN (SELECT DISTINCT discount_depth, discount_depth_rank FROM c_train) d JOIN c_lbest b ON b.subcategory = r.subcategory AND b.brand_name = r.brand_name AND b.segment = r.segment""", extra=_LX)
add("d90_tree_scores", on(lambda m: models.with_intervals(models.predict(_trees(m), m["score"], _FEATURES, _CATS),
        models.evaluate(_tree_validation(m), _TARGET), _TARGET, "p_qty_bl")),
    f"sku_root_id promo_mechanic discount_depth {_TARGET}:d prediction_interval:d prediction_error_perc:d p_cal_inc_sale_qty:d")


def _mean_scores(m: Mart) -> DataFrame:
    means, valid = _means(m)
    scored = models.apply_group_mean(m["score"], means, ["category", "discount_depth"])
    return training.price_results(models.with_intervals(scored, models.evaluate(valid, _TARGET), _TARGET, "p_qty_bl"), m["std_price_margin"])


_RX = {
    **_MEX,
    "c_meanscore": f"""SELECT s.*, g.prediction AS {_TARGET}, g.prediction * s.p_qty_bl AS p_cal_inc_sale_qty, (SELECT median(abs({_ERR})) FROM c_valid2) AS prediction_interval,
      (SELECT median(coalesce(abs({o.ratio(_ERR, _TARGET)}), 0)) FROM c_valid2) AS prediction_error_perc, p.std_price_per_unit::DOUBLE AS std_price_per_unit, p.margin_per_unit::DOUBLE AS mpu, p.cost_per_unit::DOUBLE AS cost_price
      FROM c_score s LEFT JOIN c_gm g USING (category, discount_depth) LEFT JOIN c_price p ON p.sku_root_id = s.sku_root_id""",
    "c_priced0": """SELECT *, p_qty_bl * std_price_per_unit AS p_sale_bl, p_qty_bl * mpu AS p_margin_bl, discount_depth_rank::DOUBLE / 100 AS equivalent_discount FROM c_meanscore""",
    "c_priced1": """SELECT *, (1 - equivalent_discount) * std_price_per_unit AS effective_discount_price_per_unit,
      p_cal_inc_sale_qty * (1 - equivalent_discount) * std_price_per_unit AS p_cal_inc_sale_amt FROM c_priced0""",
    "c_priced2": "SELECT *, p_cal_inc_sale_amt - p_cal_inc_sale_qty * cost_price AS p_cal_inc_margin_amt FROM c_priced1",
    "c_priced": f"""SELECT *, {o.ratio('p_cal_inc_sale_qty', 'p_qty_bl')} AS perc_uplift_qty, {o.ratio('p_cal_inc_sale_amt', 'p_sale_bl')} AS perc_uplift_amt,
      {o.ratio('p_cal_inc_margin_amt', 'p_margin_bl')} AS perc_uplift_margin FROM c_priced2""",
}
add("d91_priced_results", on(_mean_scores),
    f"sku_root_id promo_mechanic discount_depth {_TARGET}:d prediction_interval:r prediction_error_perc:r p_cal_inc_sale_qty:d p_sale_bl:d p_margin_bl:d equivalent_discount:d "
    "effective_discount_price_per_unit:d p_cal_inc_sale_amt:d p_cal_inc_margin_amt:d perc_uplift_qty:d perc_uplift_amt:d perc_uplift_margin:d", "c_priced", extra=_RX)


def _published_scores(m: Mart) -> DataFrame:
    """Leaf-wise model and its priced scores, each published and read back."""
    root = f"{m.space.folder}/uplift"
    if "published_scores" not in m._made:
        modes.publish_model(_leafwise(m), models.evaluate(_leaf_validation(m), _TARGET), _TARGET, root)
        modes.predict(m.spark, m["score"], m["std_price_margin"], root)
        m._made["published_scores"] = read_published(m.spark, f"{root}/scores")
    return m._made["published_scores"]


add("d91_tree_priced_results", on(_published_scores),
    f"sku_root_id promo_mechanic discount_depth {_TARGET}:d prediction_interval:r p_cal_inc_sale_qty:d p_sale_bl:d p_cal_inc_sale_amt:d p_cal_inc_margin_amt:d perc_uplift_amt:d perc_uplift_margin:d")
# What holds for any fit: the scored rows, their prices, and amounts that follow from the predicted quantity.
def _amounts_checked(m: Mart) -> DataFrame:
    paid = F.col("p_cal_inc_sale_qty") * F.col("effective_discount_price_per_unit")
    unknown = F.col("std_price_per_unit").isNull() | F.col("p_qty_bl").isNull()
    return _published_scores(m).withColumn("priced", F.coalesce(F.abs(F.col("p_cal_inc_sale_amt") - paid) < 1e-6, unknown))


add("d91_tree_priced_rows", on(_amounts_checked),
    "sku_root_id promo_mechanic discount_depth p_sale_bl:d p_margin_bl:d equivalent_discount:d effective_discount_price_per_unit:d priced",
    "SELECT *, TRUE AS priced FROM c_priced", extra=_RX)


def _regression_prices(m: Mart) -> DataFrame:
    """The regression chosen for a root prices every offer of its depth, in cents."""
    scored = m["score"].join(_ols_scores(m).select("sku_root_id", "discount_depth", F.col("prediction").alias(_TARGET)), ["sku_root_id", "discount_depth"])
    priced = training.price_results(scored.withColumn("p_cal_inc_sale_qty", F.col(_TARGET) * F.col("p_qty_bl")), m["std_price_margin"])
    return priced.withColumns({c: F.round(c, 2) + 0.0 for c in _REGRESSED})


_REGRESSED = ["p_cal_inc_sale_qty", "p_sale_bl", "p_cal_inc_sale_amt", "p_cal_inc_margin_amt"]
_OLX = {
    **_LX, **_RX,
    "c_olsscore": """SELECT r.sku_root_id, d.discount_depth, b.coeff_const + b.coeff_depth * d.discount_depth_rank::DOUBLE AS prediction
      FROM c_root r CROSS JOIN (SELECT DISTINCT discount_depth, discount_depth_rank FROM c_train) d JOIN c_lbest b ON b.subcategory = r.subcategory AND b.brand_name = r.brand_name AND b.segment = r.segment""",
    "c_olspriced": """SELECT s.sku_root_id, s.promo_mechanic, s.discount_depth, l.prediction * s.p_qty_bl AS q, s.p_sale_bl, l.prediction * s.p_qty_bl * s.effective_discount_price_per_unit AS a, s.cost_price
      FROM c_priced s JOIN c_olsscore l USING (sku_root_id, discount_depth)""",
}
add("d91_regression_priced_results", on(_regression_prices), "sku_root_id promo_mechanic discount_depth " + _d(_REGRESSED),
    """SELECT sku_root_id, promo_mechanic, discount_depth, round(q, 2) + 0.0 AS p_cal_inc_sale_qty, round(p_sale_bl, 2) + 0.0 AS p_sale_bl,
    round(a, 2) + 0.0 AS p_cal_inc_sale_amt, round(a - q * cost_price, 2) + 0.0 AS p_cal_inc_margin_amt FROM c_olspriced""", extra=_OLX)
_AV = ["p_cal_inc_sale_qty", "p_cal_inc_sale_amt", "p_cal_inc_margin_amt", "perc_uplift_qty", "perc_uplift_amt", "perc_uplift_margin"]
add("d92_category_brand_rollup", on(lambda m: training.rollup(_mean_scores(m))),
    f"area section category subcategory brand_name promo_mechanic Promo_mechanic_en discount_depth {_d('avg_' + c for c in _AV)} avg_prediction_interval:r avg_prediction_error_perc:r "
    f"{_d('sum_' + c for c in _AV[:3])} no_skus_in_brand_cat:i promoted_in_past:i",
    f"""SELECT area, section, category, subcategory, brand_name, promo_mechanic, Promo_mechanic_en, discount_depth, {', '.join(f'{o.mean(o.fixed(c))} AS avg_{c}' for c in [*_AV, 'prediction_interval', 'prediction_error_perc'])},
    {', '.join(f'sum({o.fixed(c)}) AS sum_{c}' for c in _AV[:3])}, count(DISTINCT sku_root_id) AS no_skus_in_brand_cat, max(promoted_in_past) AS promoted_in_past FROM c_priced GROUP BY ALL""", extra=_RX)
add("d93_top_per_category", on(lambda m: training.top_per_category(_mean_scores(m))),
    "row_num:i sku_root_id category segment brand_name promo_mechanic discount_depth counterfactual_sales_qty:d inc_sales_qty:d perc_uplift_qty:d promoted_in_past:i",
    f"""SELECT *, p_qty_bl AS counterfactual_sales_qty, p_cal_inc_sale_qty AS inc_sales_qty, up * 100 AS perc_uplift_qty FROM (SELECT * EXCLUDE (perc_uplift_qty), {o.ratio('p_cal_inc_sale_qty', 'p_qty_bl')} AS up,
    row_number() OVER (PARTITION BY category ORDER BY {o.ratio('p_cal_inc_sale_qty', 'p_qty_bl')} DESC NULLS LAST, p_cal_inc_sale_qty DESC NULLS LAST, sku_root_id, promo_mechanic, discount_depth) AS row_num
    FROM c_priced WHERE p_qty_bl > 50) WHERE row_num <= 20""", extra=_RX)
add("d94_importance_total", lambda spark, sf: models.importance(spark, _trees(open_mart(spark, sf)), _FEATURES, n=len(_FEATURES)).agg(
        F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"), F.min(F.col("importance") >= 0).alias("none_negative")),
    "features:i total:d none_negative", f"SELECT {len(_FEATURES)} AS features, 1.0 AS total, TRUE AS none_negative")
add("d94_feature_importance", lambda spark, sf: models.importance(spark, _trees(open_mart(spark, sf)), _FEATURES), "feature importance:d")

# Grouped fits without dummy columns: the discount depth as a fixed effect, then three regressors of full rank.
_X = {"a": "duration_days", "b": "no_hipermercados_stores", "c": "campaign_start_week"}


def _moments(by: str, names: str) -> str:
    """Sums of products of the regressors and the target, each less its mean by ``by``, for every category."""
    columns = {**{n: f"{_X[n]}::DOUBLE" for n in names}, "y": f"{_TARGET}::DOUBLE"}
    centred = ", ".join(f"{e} - avg({e}) OVER (PARTITION BY {by}) AS {n}" for n, e in columns.items())
    every = [*columns]
    sums = ", ".join(f"sum({p} * {q}) AS {p}{q}" for i, p in enumerate(every) for q in every[i:])
    return f"SELECT category, count(*) AS n, count(DISTINCT discount_depth) AS levels, {sums} FROM (SELECT category, discount_depth, {centred} FROM c_clean) GROUP BY category"


def _fit_columns(names: str) -> str:
    return "category n:i levels:i r2:r f:r " + " ".join(f"coeff_{_X[n]}:r" for n in names)


def _full_rank(df: DataFrame) -> DataFrame:
    return df.where((F.size("aliased") == 0) & F.col("f").isNotNull())


add("d86_absorbed_category", on(lambda m: _full_rank(absorbed.absorbed_ols(_clean(m), ["category"], ["discount_depth"], [_X[n] for n in "ab"], _TARGET))), _fit_columns("ab"),
    """SELECT category, n, levels, coeff_duration_days, coeff_no_hipermercados_stores, 1 - ssr / yy AS r2, ((yy - ssr) / 2) / (ssr / (n - 2 - levels)) AS f
    FROM (SELECT *, (ay * bb - by_ * ab) / det AS coeff_duration_days, (by_ * aa - ay * ab) / det AS coeff_no_hipermercados_stores, yy - (ay * (ay * bb - by_ * ab) + by_ * (by_ * aa - ay * ab)) / det AS ssr
      FROM (SELECT * RENAME ("by" AS by_), aa * bb - ab * ab AS det FROM c_moments) WHERE det > 1e-9 * aa * bb AND n > levels + 2)""", extra={**_MEX, "c_moments": _moments("category, discount_depth", "ab")})
add("d84_three_regressors", on(lambda m: _full_rank(absorbed.absorbed_ols(_clean(m), ["category"], [], [_X[n] for n in "abc"], _TARGET))), _fit_columns("abc"),
    """SELECT category, n, 1 AS levels, p AS coeff_duration_days, q AS coeff_no_hipermercados_stores, r AS coeff_campaign_start_week,
      (p * ay + q * by_ + r * cy) / yy AS r2, ((p * ay + q * by_ + r * cy) / 3) / ((yy - p * ay - q * by_ - r * cy) / (n - 4)) AS f
    FROM (SELECT *, (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS p,
        (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS q,
        (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS r
      FROM (SELECT * RENAME ("by" AS by_), aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM c_moments) WHERE det > 1e-9 * aa * bb * cc AND n > 4)""",
    extra={**_MEX, "c_moments": _moments("category", "abc")})
