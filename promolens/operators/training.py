"""Training and scoring tables of the uplift models, and the priced results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import all_pairs
from ..functions.numeric import RATE, dbl, fixed, mean_of, ratio
from .counterfactual import scope
from .promo_facts import ROOT_FULL

STORE_COUNTS = [
    "no_hipermercados_stores", "no_supermercados_stores", "no_gasolineras_stores",
    "no_comercio_electronico_stores", "no_otros_negocio_stores", "no_plataformas_stores", "no_other_stores",
    "no_impacted_stores", "no_impacted_regions",
]
DISPLAY = ["leaflet_cover", "leaflet_priv_space", "in_leaflet_flag", "in_gondola_flag", "in_both_leaflet_gondola_flag"]
ROOT_KEPT = [c for c in ROOT_FULL if c not in ("own_brand_flag", "own_brand_label", "wealthy_range_flag", "wow_flag")]
CAMPAIGN_KEPT = [
    "name", "type", "start_date", "end_date", "customer_profile_type", "marketing_type",
    "campaign_start_day", "campaign_start_month", "campaign_start_quarter", "campaign_start_week",
]
# The sums of the training table and the counterfactual_promo columns they add up.
SUMS = {
    "p_discount": "tt_discount", "p_sale_bl": "sale_amt_bl", "p_qty_bl": "sale_qty_bl", "p_margin_bl": "margin_amt_bl",
    "p_sale_amt": "tt_sale_amt", "p_sale_qty": "tt_sale_qty", "p_margin_amt": "tt_margin_amt",
    "p_cal_inc_sale_amt": "inc_sale_amt", "p_cal_inc_sale_qty": "inc_sale_qty", "p_cal_inc_margin_amt": "inc_margin_amt",
    "p_avg_sale_bl": "avg_bline_sale", "p_avg_qty_bl": "avg_bline_qty", "p_avg_margin_bl": "avg_bline_margin",
    "p_cal_inc_avg_sale": "avg_bl_inc_sale", "p_cal_inc_avg_qty": "avg_bl_inc_qty", "p_cal_avg_margin": "avg_bl_inc_margin",
}
# Ratios of the training table as (numerator, denominator).
RATIOS = {
    "p_cal_inc_sale_amt_per_store": ("p_cal_inc_sale_amt", "no_impacted_stores"),
    "p_cal_inc_sale_qty_per_store": ("p_cal_inc_sale_qty", "no_impacted_stores"),
    "p_cal_inc_margin_amt_per_store": ("p_cal_inc_margin_amt", "no_impacted_stores"),
    "p_cal_perc_inc_sale_amt": ("p_cal_inc_sale_amt", "p_sale_bl"),
    "p_cal_perc_inc_sale_qty": ("p_cal_inc_sale_qty", "p_qty_bl"),
    "p_cal_perc_inc_margin": ("p_cal_inc_margin_amt", "p_margin_bl"),
    "p_cal_inc_avg_sale_per_store": ("p_cal_inc_avg_sale", "no_impacted_stores"),
    "p_cal_inc_avg_qty_per_store": ("p_cal_inc_avg_qty", "no_impacted_stores"),
    "p_cal_avg_margin_per_store": ("p_cal_avg_margin", "no_impacted_stores"),
    "p_cal_perc_inc_avg_sale_amt": ("p_cal_inc_avg_sale", "p_avg_sale_bl"),
    "p_cal_perc_inc_avg_sale_qty": ("p_cal_inc_avg_qty", "p_avg_qty_bl"),
    "p_cal_perc_inc_avg_margin": ("p_cal_avg_margin", "p_avg_margin_bl"),
}


def price_label() -> Column:
    """Own-brand label, else the label of the wealth range."""
    wealth = F.when(F.col("wealthy_range_flag") == "N", "Normal").when(F.col("wealthy_range_flag") == "S", "Premium")
    return F.coalesce("own_brand_label", wealth)


def _promo_rows(counterfactual_promo: DataFrame, roots: DataFrame, area: str | None, mechanics: list[str]) -> DataFrame:
    rows = counterfactual_promo.where(F.col("promo_mechanic").isin([str(m) for m in mechanics]))
    if area is not None:
        rows = rows.join(scope(roots, area).select("sku_root_id"), "sku_root_id", "left_semi")
    return rows


def _period() -> Column:
    return F.when(F.col("change_flag").isin(1, 2), "promotion").otherwise("post_promotion")


_KEY = ["sku_root_id", "promo_id", "promo_year", "promo_mechanic", "promo_mechanic_description",
        "discount_depth", "discount_depth_rank"]


def _finish(sums: DataFrame, detail: DataFrame, roots: DataFrame) -> DataFrame:
    about = detail.select("promo_id", F.col("promo_year").cast("string").alias("promo_year"), *CAMPAIGN_KEPT,
                          F.col("duration").alias("duration_days"))
    labelled = roots.select("sku_root_id", *ROOT_KEPT, price_label().alias("brand_price_label"))
    return (
        sums.join(about, ["promo_id", "promo_year"])
        .join(labelled, "sku_root_id")
        .where(
            F.col("discount_depth").isNotNull() & F.col("promo_mechanic").isNotNull()
            & F.col("sku_root_id").isNotNull() & F.col("segment").isNotNull()
        )
        .withColumnRenamed("promo_mechanic_description", "Promo_mechanic_en")
    )


def train_table(
    counterfactual_promo: DataFrame, detail: DataFrame, roots: DataFrame, mechanics: list[str],
    area: str | None = None, period: str = "promotion",
) -> DataFrame:
    """Sums and ratios per promotion and root over the weeks of one period."""
    rows = _promo_rows(counterfactual_promo, roots, area, mechanics).withColumn("period", _period())
    sums = rows.where(F.col("period") == period).groupBy(*_KEY, *STORE_COUNTS, *DISPLAY, "period").agg(
        mean_of(fixed("avg_store_size")).alias("avg_store_size"),
        F.max("includes_weekend").alias("includes_weekend"),
        *[F.sum(c).cast(RATE).alias(n) for n, c in SUMS.items()],
    )
    return _finish(sums.withColumns({n: ratio(a, b) for n, (a, b) in RATIOS.items()}), detail, roots)


def post_train_table(
    counterfactual_promo: DataFrame, detail: DataFrame, roots: DataFrame, mechanics: list[str] = ("10", "20"),
    area: str | None = None,
) -> DataFrame:
    """The same grain after the promotion, with mean weekly uplift percentages."""
    pct = {
        "pct_inc_sale": ("inc_sale_amt", "sale_amt_bl"),
        "pct_inc_qty": ("inc_sale_qty", "sale_qty_bl"),
        "pct_inc_margin": ("inc_margin_amt", "margin_amt_bl"),
    }
    rows = _promo_rows(counterfactual_promo, roots, area, list(mechanics)).withColumn("period", _period())
    summed = list(SUMS)[:10]
    sums = rows.where(F.col("period") == "post_promotion").groupBy(
        *_KEY, "no_impacted_stores", "no_impacted_regions", *DISPLAY, "period"
    ).agg(
        mean_of(fixed("avg_store_size")).alias("avg_store_size"),
        F.max("includes_weekend").alias("includes_weekend"),
        *[F.sum(SUMS[n]).cast(RATE).alias(n) for n in summed],
        *[mean_of(fixed(ratio(a, b))).alias(n) for n, (a, b) in pct.items()],
    )
    return _finish(sums.where(F.col("pct_inc_sale").isNotNull()), detail, roots)


def _default_features(weekend: bool) -> dict[str, Column]:
    # Features of the promotion that is scored.
    plain = {
        "no_impacted_stores": 100, "no_impacted_regions": 5, "avg_store_size": 500, "type": 1,
        "customer_profile_type": 0, "marketing_type": "Oferta corporativa", "duration_days": 14,
        "includes_weekend": weekend, "campaign_start_day": "Thursday", "campaign_start_month": "Jan",
        "campaign_start_quarter": 1, "campaign_start_week": 2, "leaflet_cover": 0, "leaflet_priv_space": 0,
        "in_leaflet_flag": 1, "in_gondola_flag": 1, "in_both_leaflet_gondola_flag": 1,
    }
    return {k: F.lit(v) for k, v in plain.items()}


def _store_mix() -> dict[str, Column]:
    # Store formats of the promotion that is scored.
    mix = {"no_hipermercados_stores": 50, "no_supermercados_stores": 50}
    return {c: F.lit(mix.get(c, 0)) for c in STORE_COUNTS[:7]}


def _score(roots: DataFrame, train: DataFrame, quantity: DataFrame, features: dict[str, Column], depth: list[str]) -> DataFrame:
    about = roots.select("sku_root_id", *ROOT_KEPT, price_label().alias("brand_price_label"))
    offers = train.select(*depth).distinct()
    past = train.select("sku_root_id", "discount_depth").distinct().withColumn("promoted_in_past", F.lit(1))
    skus = about.join(quantity, "sku_root_id", "left").withColumns(features)
    return all_pairs(skus, offers).join(past, ["sku_root_id", "discount_depth"], "left")


def score_table(
    roots: DataFrame, train: DataFrame, weekly_fact: DataFrame, stores: int = 100, weeks: int = 2,
    area: str | None = None, section: str | None = None,
) -> DataFrame:
    """Every root with every known offer; counterfactual from unpromoted weeks per store."""
    usual = weekly_fact.where(F.col("promo_flag") == 0).groupBy("sku_root_id").agg(
        (mean_of("total_sale_qty") * stores * weeks).alias("p_qty_bl")
    )
    depth = ["promo_mechanic", "Promo_mechanic_en", "discount_depth", "discount_depth_rank"]
    features = {**_store_mix(), **_default_features(True)}
    return _score(scope(roots, area, section), train, usual, features, depth)


def post_score_table(
    roots: DataFrame, train: DataFrame, forecast_metrics: DataFrame, weeks: int = 1, section: str | None = None
) -> DataFrame:
    """As ``score_table`` with the forecast as counterfactual; roots without one drop out."""
    expected = forecast_metrics.where(F.col("metric") == "pred_counterfactual_sale_qty").select(
        "sku_root_id", (F.col("avg_forecast_period") * weeks).alias("p_qty_bl")
    )
    known = scope(roots, None, section).join(expected.select("sku_root_id"), "sku_root_id", "left_semi")
    depth = ["promo_mechanic", "Promo_mechanic_en", "discount_depth"]
    return _score(known, train, expected, _default_features(False), depth)


def price_results(scored: DataFrame, prices: DataFrame) -> DataFrame:
    """Value of the predicted uplift at the discounted price."""
    std = prices.select(
        "sku_root_id", dbl("margin_per_unit").alias("std_margin_per_unit"),
        dbl("std_price_per_unit").alias("std_price_per_unit"), dbl("cost_per_unit").alias("cost_price"),
    )
    qty, base, price = dbl("p_cal_inc_sale_qty"), dbl("p_qty_bl"), F.col("std_price_per_unit")
    return (
        scored.join(std, "sku_root_id", "left")
        .withColumn("p_sale_bl", base * price)
        .withColumn("p_margin_bl", base * F.col("std_margin_per_unit"))
        .withColumn("equivalent_discount", dbl("discount_depth_rank") / 100)
        .withColumn("effective_discount_price_per_unit", (1 - F.col("equivalent_discount")) * price)
        .withColumn("p_cal_inc_sale_amt", qty * (1 - F.col("equivalent_discount")) * price)
        .withColumn("p_cal_inc_margin_amt", F.col("p_cal_inc_sale_amt") - qty * F.col("cost_price"))
        .withColumn("perc_uplift_qty", ratio(qty, base))
        .withColumn("perc_uplift_amt", ratio("p_cal_inc_sale_amt", "p_sale_bl"))
        .withColumn("perc_uplift_margin", ratio("p_cal_inc_margin_amt", "p_margin_bl"))
    )


def rollup(results: DataFrame) -> DataFrame:
    """Averages and sums per hierarchy node, brand and offer."""
    key = ["area", "section", "category", "subcategory", "brand_name", "promo_mechanic", "Promo_mechanic_en", "discount_depth"]
    amounts = ["p_cal_inc_sale_qty", "p_cal_inc_sale_amt", "p_cal_inc_margin_amt"]
    averaged = [*amounts, "perc_uplift_qty", "perc_uplift_amt", "perc_uplift_margin",
                "prediction_interval", "prediction_error_perc"]
    return results.groupBy(*key).agg(
        *[mean_of(fixed(c)).alias(f"avg_{c}") for c in averaged],
        *[dbl(F.sum(fixed(c))).alias(f"sum_{c}") for c in amounts],
        F.count_distinct("sku_root_id").alias("no_skus_in_brand_cat"),
        F.max("promoted_in_past").alias("promoted_in_past"),
    )


def top_per_category(results: DataFrame, n: int = 20, min_base: float = 50.0) -> DataFrame:
    """Best offers of a category; rank limits are pushed below the shuffle by Spark."""
    uplift = ratio("p_cal_inc_sale_qty", "p_qty_bl")
    w = Window.partitionBy("category").orderBy(
        F.col("_uplift").desc_nulls_last(), F.col("p_cal_inc_sale_qty").desc_nulls_last(),
        "sku_root_id", "promo_mechanic", "discount_depth",
    )
    ranked = results.where(F.col("p_qty_bl") > min_base).withColumn("_uplift", uplift).withColumn("row_num", F.row_number().over(w))
    return ranked.where(F.col("row_num") <= n).select(
        "row_num", "sku_root_id", "description", "area", "section", "category", "subcategory", "segment",
        "brand_name", "brand_price_label", "flag_healthy", "innovation_flag", "tourism_flag", "local_flag",
        "regional_flag", "promo_mechanic", "Promo_mechanic_en", "discount_depth",
        F.col("p_qty_bl").alias("counterfactual_sales_qty"), F.col("p_cal_inc_sale_qty").alias("inc_sales_qty"),
        (F.col("_uplift") * 100).alias("perc_uplift_qty"), "promoted_in_past",
    )


