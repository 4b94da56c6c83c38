"""Sales of every offer by day, week and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import each_day, week_start
from ..functions.numeric import RATE, dbl, depth_step, fixed, mean_of, percent_off, rate_sum, ratio
from .facts import PAIR, PROMO
from .sales import OFFER_MEASURES

# Mechanics that need a depth or a price, and store formats that are counted.
DEPTH_MECHANICS = ["10", "20", "30", "40", "60"]
FORMAT_COUNTS = {
    "HIPERMERCADOS": "no_hipermercados_stores",
    "SUPERMERCADOS": "no_supermercados_stores",
    "GASOLINERAS": "no_gasolineras_stores",
    "COMERCIO ELECTRONICO": "no_comercio_electronico_stores",
    "OTROS NEGOCIOS": "no_otros_negocio_stores",
    "PLATAFORMAS": "no_plataformas_stores",
    "69": "no_other_stores",
}
PRICE_CUT = "10"
SHARED = ["total_sale_amt", "total_sale_qty", "total_margin_amt", "total_price_if_sku_std_price"]
OFFER_KEY = [*PROMO, *PAIR, "promo_mechanic", "promo_mechanic_description", "discount_depth_rank", "discount_depth"]
PROMO_KEY = [*PROMO, "sku_root_id", "promo_mechanic", "promo_mechanic_description", "discount_depth_rank", "discount_depth"]
DISPLAY = ["leaflet_cover", "leaflet_priv_space", "in_leaflet_flag", "in_gondola_flag", "in_both_leaflet_gondola_flag"]
ALLOCATED = ["total_sale_amt", "total_sale_qty", "total_margin_amt", "total_discount_amt"]
CAMPAIGN_ATTRIBUTES = [
    "name", "type", "start_date", "end_date", "class", "customer_profile_type", "marketing_type", "duration",
    "campaign_start_day", "campaign_start_month", "campaign_start_quarter", "campaign_start_week",
]
ROOT_FULL = [
    "description", "area", "section", "category", "subcategory", "segment", "brand_name",
    "own_brand_flag", "own_brand_label", "wealthy_range_flag", "flag_healthy", "innovation_flag",
    "tourism_flag", "local_flag", "regional_flag", "wow_flag",
]


def campaign_detail(campaigns: DataFrame, cal: DataFrame) -> DataFrame:
    """Campaign attributes with length and calendar facts of the first day."""
    start = cal.select(
        F.col("date").alias("start_date"),
        F.col("day").alias("campaign_start_day"),
        F.col("month").alias("campaign_start_month"),
        F.col("quarter").alias("campaign_start_quarter"),
        F.col("week").alias("campaign_start_week"),
    )
    length = F.datediff("end_date", "start_date") + 1
    return campaigns.withColumn("duration", length).join(start, "start_date").select(*PROMO, *CAMPAIGN_ATTRIBUTES)


def store_detail(stores: DataFrame) -> DataFrame:
    return stores.select(
        "store_id", "store_geography_region",
        F.col("store_type1").alias("store_format"),
        F.col("size_m2").alias("store_size"),
    )


def with_attributes(df: DataFrame, detail: DataFrame, roots: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Widen narrow promo rows with campaign, root and store attributes."""
    wide = df.join(detail.select(*PROMO, *[c for c in CAMPAIGN_ATTRIBUTES if c not in df.columns]), PROMO)
    wide = wide.join(roots.select("sku_root_id", *ROOT_FULL), "sku_root_id")
    return wide if stores is None else wide.join(store_detail(stores), "store_id")


def valid_offers(promo_to_sku: DataFrame) -> DataFrame:
    """One row per root, store, mechanic and depth of a promotion."""
    listed = F.col("promo_mechanic").isin(DEPTH_MECHANICS)
    priced = F.col("discount_depth").isNotNull() | F.col("discounted_price_promo").isNotNull()
    return promo_to_sku.where((listed & priced) | ~listed).groupBy(*OFFER_KEY).agg(
        F.max("std_price").alias("std_price"),
        F.min("discounted_price_promo").alias("discounted_price_promo"),
        *[F.max(c).alias(c) for c in DISPLAY],
    )


def offer_rows(promo_to_sku: DataFrame, stores: DataFrame, roots: DataFrame) -> DataFrame:
    """Valid offers of known stores and roots, with their number per promotion.

    Every offer of a promotion runs on all its days, so the number is the same each day.
    """
    together = Window.partitionBy(*PROMO, *PAIR)
    return (
        valid_offers(promo_to_sku)
        .join(stores.select("store_id"), "store_id", "left_semi")
        .join(roots.select("sku_root_id"), "sku_root_id", "left_semi")
        .withColumn("n_promo_mech", F.count(F.lit(1)).over(together))
    )


def offer_days(offers: DataFrame, days: DataFrame, daily_fact: DataFrame, daily_promo_fact: DataFrame) -> DataFrame:
    """Sales on the days of every root, store and promotion, whatever its number of offers.

    The facts are joined at this narrow grain; offers fan out afterwards.
    """
    day = ["date", *PAIR]
    booked = daily_promo_fact.where(F.col("promo_id").isNotNull()).select(
        *day, *PROMO, *[F.col(m).alias(f"pr_{m}") for m in SHARED], *OFFER_MEASURES
    )
    unbooked = daily_promo_fact.where(F.col("promo_id").isNull() & F.col("promo_year").isNull()).select(
        *day, *[F.col(m).alias(f"npr_{m}") for m in SHARED]
    )
    observed = daily_fact.select(*day, F.col("std_price_per_unit").alias("observed_price"), "n_promo")
    return (
        offers.select(*PROMO, *PAIR).distinct()
        .join(days, PROMO)
        .join(observed, day, "left")
        .join(unbooked, day, "left")
        .join(booked, [*day, *PROMO], "left")
    )


def promo_daily(offers: DataFrame, day_rows: DataFrame) -> DataFrame:
    """Valid offers on every campaign day; a missing usual price is the day's observed one."""
    price = F.coalesce(F.col("std_price").cast(RATE), F.col("observed_price"))
    return offers.join(day_rows, [*PROMO, *PAIR]).withColumn("std_price", price).drop("observed_price")


def allocate(promo_rows: DataFrame) -> DataFrame:
    """Give every offer row its part of the day's sales.

    Sales booked on the promotion are shared by its offer rows; sales without a
    promotion are shared by all offer rows of all the day's promotions.
    """
    mech, all_rows = F.col("n_promo_mech"), F.col("n_promo_mech") * F.col("n_promo")

    def share(m: str) -> Column:
        own = dbl(f"pr_{m}") * ratio(F.lit(1), mech)
        common = dbl(f"npr_{m}") * ratio(F.lit(1), all_rows)
        return F.coalesce(own, F.lit(0.0)) + F.coalesce(common, F.lit(0.0))

    offer, std = F.col("discounted_price_promo"), F.col("std_price")
    cut = (F.col("promo_mechanic") == PRICE_CUT) & (offer > 0) & (std > 0) & (std >= offer)
    return promo_rows.withColumns({
        "discount_depth_10": F.when(cut, fixed(100 * (1 - ratio(offer, std)))),
        **{m: fixed(share(m)) for m in SHARED[:3]},
        "total_discount_amt": fixed(share("total_sale_amt") - share("total_price_if_sku_std_price")),
    })


def matched(allocated: DataFrame) -> DataFrame:
    """Only roots and stores that appear in the sales facts."""
    return allocated.where(F.col("n_promo").isNotNull())


def depth_by_store(rows: DataFrame) -> DataFrame:
    key = [*PROMO, *PAIR, "promo_mechanic", "discount_depth_rank", "discount_depth"]
    return rows.where(F.col("promo_mechanic") == PRICE_CUT).groupBy(*key).agg(
        *[fixed(mean_of(c)).alias(c) for c in ("discounted_price_promo", "std_price", "discount_depth_10")]
    )


def depth_summary(rows: DataFrame) -> DataFrame:
    """Depth of a price cut per promotion and root: mean over stores of means over days."""
    key = [*PROMO, "sku_root_id", "promo_mechanic", "discount_depth_rank", "discount_depth"]
    means = depth_by_store(rows).groupBy(*key).agg(
        *[fixed(mean_of(c)).alias(c) for c in ("discounted_price_promo", "std_price", "discount_depth_10")]
    )
    step = depth_step(F.col("discount_depth_10"))
    return means.withColumn("discount_depth", F.coalesce(percent_off(step), "discount_depth")).withColumn(
        "discount_depth_rank", F.coalesce(fixed(step), "discount_depth_rank")
    )


def final_offers(offers: DataFrame, depths: DataFrame, weekly_fact: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Offers with the final depth and the promo flags of the weeks around.

    Neither depends on the day, so both are attached before offers fan out to days.
    """
    cut = depths.select(
        *PROMO, "sku_root_id", "promo_mechanic",
        F.col("discount_depth").alias("_depth"), F.col("discount_depth_rank").alias("_rank"),
    )
    around = campaigns.select(
        *PROMO,
        F.date_sub(week_start("start_date"), 7).alias("_before"),
        F.date_add(week_start("end_date"), 7).alias("_after"),
    )
    flags = weekly_fact.select(*PAIR, F.col("date").alias("_week"), F.col("promo_flag").alias("_flag"))
    before = flags.withColumnsRenamed({"_week": "_before", "_flag": "promo_prev_week"})
    after = flags.withColumnsRenamed({"_week": "_after", "_flag": "promo_pf_week"})
    is_cut = F.col("promo_mechanic") == PRICE_CUT
    return (
        offers.join(around, PROMO)
        .join(cut, [*PROMO, "sku_root_id", "promo_mechanic"], "left")
        .join(before, [*PAIR, "_before"], "left")
        .join(after, [*PAIR, "_after"], "left")
        .withColumn("discount_depth", F.when(is_cut, F.col("_depth")).otherwise(F.col("discount_depth")))
        .withColumn("discount_depth_rank", F.when(is_cut, F.col("_rank")).otherwise(F.col("discount_depth_rank")))
        .drop("_before", "_after", "_depth", "_rank")
    )


def promo_daily_total(finals: DataFrame, day_rows: DataFrame) -> DataFrame:
    """Daily sales of the final offers."""
    return matched(allocate(promo_daily(finals, day_rows))).select(
        "date", *OFFER_KEY, *DISPLAY, "n_promo_mech", "n_promo", "promo_prev_week", "promo_pf_week",
        *ALLOCATED, *OFFER_MEASURES,
    )


def promo_weekly_total(daily_total: DataFrame) -> DataFrame:
    highest = [*DISPLAY, "n_promo_mech", "n_promo", "promo_prev_week", "promo_pf_week"]
    return daily_total.groupBy(week_start("date").alias("date"), *OFFER_KEY).agg(
        F.max(F.dayofweek("date").isin(1, 7)).alias("includes_weekend"),
        *[F.max(c).alias(c) for c in highest],
        F.count(F.lit(1)).alias("n_days_promo_week"),
        *[rate_sum(m).alias(m) for m in [*ALLOCATED, *OFFER_MEASURES]],
    )


def promo_summary(
    weekly_total: DataFrame, weekly_fact: DataFrame, campaigns: DataFrame, stores: DataFrame
) -> DataFrame:
    """Weekly totals of a promotion over stores, with neighbour-week and average quantities.

    The previous week is looked up at the week before the start, the following one
    at the week after the end. Rows without a depth are dropped.
    """
    quantity = weekly_fact.select(*PAIR, F.col("date").alias("_week"), F.col("total_sale_qty").alias("_qty"))
    usual = weekly_fact.groupBy(*PAIR).agg(
        mean_of(F.when(F.col("promo_flag") == 0, F.col("total_sale_qty"))).alias("_avg"),
        mean_of("total_sale_qty").alias("_avg_all"),
    )
    around = campaigns.select(
        *PROMO,
        F.date_sub(week_start("start_date"), 7).alias("_before"),
        F.date_add(week_start("end_date"), 7).alias("_after"),
    )
    before = quantity.withColumnsRenamed({"_week": "_before", "_qty": "_prev"})
    after = quantity.withColumnsRenamed({"_week": "_after", "_qty": "_next"})
    part = ratio("n_days_promo_week", F.lit(7))
    rows = (
        weekly_total.where(F.col("discount_depth").isNotNull())
        .join(around, PROMO)
        .join(before, [*PAIR, "_before"], "left")
        .join(after, [*PAIR, "_after"], "left")
        .join(usual, PAIR, "left")
        .join(store_detail(stores), "store_id")
    )
    formats = [
        F.count_if(F.col("store_format") == label).alias(name) for label, name in FORMAT_COUNTS.items()
    ]
    highest = ["includes_weekend", *DISPLAY, "n_promo_mech", "n_promo", "promo_prev_week", "promo_pf_week"]
    return rows.groupBy("date", *PROMO_KEY).agg(
        *formats,
        F.sort_array(F.collect_set("store_id")).alias("store_ids"),
        F.size(F.collect_set("store_id")).alias("no_impacted_stores"),
        F.size(F.collect_set("store_geography_region")).alias("no_impacted_regions"),
        mean_of("store_size").alias("avg_store_size"),
        *[F.max(c).alias(c) for c in highest],
        mean_of("n_days_promo_week").alias("n_days_promo_week"),
        *[rate_sum(m).alias(m) for m in [*ALLOCATED, *OFFER_MEASURES]],
        rate_sum("_prev").alias("s_prev_bl_qty"),
        rate_sum(fixed(dbl("_prev") * part)).alias("s_prev_bl_qty_norm"),
        rate_sum("_next").alias("pf_after_bl_qty"),
        rate_sum(fixed(F.col("_avg") * part)).alias("avg_bline_qty"),
        rate_sum(fixed(F.col("_avg_all") * part)).alias("avg_bline_qty_all"),
    )


def post_promo(finals: DataFrame, daily_total: DataFrame, daily_fact: DataFrame, campaigns: DataFrame, days: int = 28) -> DataFrame:
    """Sales of the days after the end of every offer that has sales days."""
    live = daily_total.select(*PROMO, *PAIR).distinct()
    ends = campaigns.select(*PROMO, each_day(F.date_add("end_date", 1), F.date_add("end_date", days)).alias("date"))
    sales = daily_fact.select(
        "date", *PAIR,
        F.col("total_sale_amt").alias("pf_sale_amt"),
        F.col("total_sale_qty").alias("pf_sale_qty"),
        F.col("total_margin_amt").alias("pf_margin_amt"),
        F.col("n_promo").alias("pf_n_promo"),
        F.col("promo_flag").alias("pf_promo_flag"),
    )
    offers = finals.select(*OFFER_KEY, *DISPLAY, "n_promo_mech", "promo_prev_week").distinct()
    return live.join(ends, PROMO).join(sales, ["date", *PAIR]).join(offers, [*PROMO, *PAIR])
