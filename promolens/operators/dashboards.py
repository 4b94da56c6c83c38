"""Incremental sales of promotions and their Pareto ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.numeric import MONEY, RATE, dbl, fixed
from ..functions.ranking import with_percent_rank
from .facts import PAIR

KEY = ["sku_root_id", "promo_id", "promo_year", "promo_mechanic", "discount_depth"]
INCREMENTS = ["inc_margin_amt", "inc_sale_amt", "inc_sale_qty"]
# Attributes of a promotion that do not change from week to week.
STABLE = [
    "promo_mechanic_description", "discount_depth_rank", "no_hipermercados_stores", "no_supermercados_stores",
    "no_gasolineras_stores", "no_comercio_electronico_stores", "no_otros_negocio_stores", "no_plataformas_stores",
    "no_other_stores", "no_impacted_stores", "no_impacted_regions", "avg_store_size", "leaflet_cover",
    "leaflet_priv_space", "in_leaflet_flag", "in_gondola_flag", "in_both_leaflet_gondola_flag", "n_promo_mech",
    "n_promo", "promo_prev_week", "promo_pf_week", "n_days_promo_week", "s_prev_bl_qty_norm", "avg_bline_qty_all",
]


def _keyed(promo_summary: DataFrame) -> DataFrame:
    return promo_summary.withColumn("promo_year", F.col("promo_year").cast("string")).withColumn(
        "discount_depth", F.coalesce("discount_depth", F.lit("ISNULL"))
    )


def forward_sales(promo_summary: DataFrame, weekly_fact: DataFrame, campaigns: DataFrame, weeks: int = 4) -> DataFrame:
    """Actual sales of a promotion's stores in the weeks after its end."""
    stores = _keyed(promo_summary).select(*KEY, F.explode("store_ids").alias("store_id")).distinct()
    first = F.date_add(week_start("end_date"), 7)
    after = F.explode(F.sequence(first, F.date_add(first, 7 * (weeks - 1)), F.expr("interval 7 days")))
    ends = campaigns.select("promo_id", F.col("promo_year").cast("string").alias("promo_year"), after.alias("date"))
    given = (F.col("total_price_if_sku_std_price") - F.col("total_sale_amt")).cast(MONEY)
    sales = weekly_fact.select(
        "date", *PAIR, "total_sale_qty", "total_sale_amt", "total_margin_amt", given.alias("discount")
    )
    return (
        stores.join(ends, ["promo_id", "promo_year"])
        .join(sales, ["date", *PAIR])
        .groupBy("date", *KEY)
        .agg(
            F.sum("total_sale_qty").cast(MONEY).alias("s_fw_bl_qty"),
            F.sum("total_sale_amt").cast(MONEY).alias("s_fw_bl_sale"),
            F.sum("total_margin_amt").cast(MONEY).alias("s_fw_bl_margin"),
            F.sum("discount").cast(MONEY).alias("s_fw_bl_discount"),
        )
    )


def store_promo_weeks(counterfactual: DataFrame, promo_summary: DataFrame) -> DataFrame:
    """For every week of a promotion id, how many of its stores are on any promotion.

    One row per week and store of the promotion meets the stores on promotion by a semi join, and is counted at once.
    """
    stores = _keyed(promo_summary).select("date", *KEY, F.explode("store_ids").alias("_store"))
    mine, on = stores.select(*KEY, "_store").distinct(), stores.select("date", "sku_root_id", "_store")
    weeks = counterfactual.select("date", "uniq_id", *KEY).join(mine, KEY)
    return (
        weeks.join(on, ["date", "sku_root_id", "_store"], "left_semi")
        .groupBy("date", "uniq_id")
        .agg(F.count_distinct("_store").cast("int").alias("store_promo_flag"))
    )


def counterfactual_promo(
    counterfactual: DataFrame, promo_summary: DataFrame, weekly_fact: DataFrame, prices: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Actual, expected and incremental sales of every promotion week.

    Attributes of a promotion come from its first week, so weeks never multiply.
    """
    bl = counterfactual.withColumn("discount_depth", F.coalesce("discount_depth", F.lit("ISNULL"))).withColumnRenamed(
        "total_sale_qty", "tt_sale_qty_ref"
    )
    summary = _keyed(promo_summary)
    own = summary.select(
        "date", *KEY, "includes_weekend", "avg_bline_qty", "s_prev_bl_qty", "pf_after_bl_qty",
        F.col("total_sale_qty").alias("promo_sale_qty"),
        F.col("total_sale_amt").alias("promo_sale_amt"),
        F.col("total_margin_amt").alias("promo_margin_amt"),
        "total_discount_amt", "oferta_promo_total_sale_amt", "oferta_promo_total_sale_qty",
        "oferta_promo_total_margin_amt", "oferta_promo_total_discount_amt",
    )
    stable = summary.groupBy(*KEY).agg(F.min_by(F.struct(*STABLE), "date").alias("s")).select(*KEY, "s.*")
    forward = forward_sales(promo_summary, weekly_fact, campaigns)
    extension = F.col("change_flag") == 3
    price, margin = dbl("std_price_per_unit"), dbl("margin_per_unit")

    def actual(after: str, during: str) -> Column:
        return F.when(extension, F.col(after).cast(RATE)).otherwise(F.col(during).cast(RATE))

    rows = (
        bl.join(forward, ["date", *KEY], "left")
        .join(own, ["date", *KEY], "left")
        .join(prices.drop("cost_per_unit"), "sku_root_id", "left")
        .join(stable, KEY, "left")
        .withColumns({
            "tt_sale_qty": actual("s_fw_bl_qty", "promo_sale_qty"),
            "tt_sale_amt": actual("s_fw_bl_sale", "promo_sale_amt"),
            "tt_margin_amt": actual("s_fw_bl_margin", "promo_margin_amt"),
            "tt_discount": actual("s_fw_bl_discount", "total_discount_amt"),
            "sale_qty_bl": fixed("sale_qty_bl"),
            "sale_amt_bl": fixed(dbl("sale_qty_bl") * price),
            "margin_amt_bl": fixed(dbl("sale_qty_bl") * margin),
            "avg_bline_sale": fixed(dbl("avg_bline_qty") * price),
            "avg_bline_margin": fixed(dbl("avg_bline_qty") * margin),
            "includes_weekend": F.coalesce("includes_weekend", F.lit(True)),
        })
        .drop("std_price_per_unit", "margin_per_unit", "s_fw_bl_qty", "s_fw_bl_sale", "s_fw_bl_margin", "s_fw_bl_discount")
    )

    def minus(a: str, b: str) -> Column:
        return (F.col(a) - F.col(b)).cast(RATE)

    out = rows.withColumns({
        "inc_sale_amt": minus("tt_sale_amt", "sale_amt_bl"),
        "inc_sale_qty": minus("tt_sale_qty", "sale_qty_bl"),
        "inc_margin_amt": minus("tt_margin_amt", "margin_amt_bl"),
        "avg_bl_inc_sale": minus("tt_sale_amt", "avg_bline_sale"),
        "avg_bl_inc_qty": minus("tt_sale_qty", "avg_bline_qty"),
        "avg_bl_inc_margin": minus("tt_margin_amt", "avg_bline_margin"),
        **{f"ext_{m}_bl": F.when(extension, F.col(f"{m}_bl")) for m in ("sale_amt", "sale_qty", "margin_amt")},
        **{f"promo_{m}_bl": F.when(~extension, F.col(f"{m}_bl")) for m in ("sale_amt", "sale_qty", "margin_amt")},
        "promo_flag": F.when(~extension, 1),
    })
    return out.join(store_promo_weeks(counterfactual_keys(bl), promo_summary), ["date", "uniq_id"], "left")


def counterfactual_keys(bl: DataFrame) -> DataFrame:
    return bl.select("date", "uniq_id", *KEY)


def _ranked(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    ranked = with_percent_rank(df.select(*keys, "sku_root_id", measure), keys, measure, "_rank")
    return ranked.withColumn("percentile_rank_inc", F.round("_rank", 2)).drop("_rank")


def pareto_ranks(totals: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Every root with its rank by each measure: one row per key and root."""
    frames = [
        _ranked(totals, keys, m).withColumnRenamed("percentile_rank_inc", rank) for m, rank in measures.items()
    ]
    return reduce(lambda a, b: a.join(b, [*keys, "sku_root_id"], "full"), frames)


def pareto(totals: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Per key and rank: total of each measure and the roots that hold the rank."""
    frames = []
    for m, label in measures.items():
        ranked = _ranked(totals, keys, m)
        frames.append(
            ranked.groupBy(*keys, "percentile_rank_inc").agg(
                F.sum(m).cast(RATE).alias(m),
                F.sort_array(F.collect_list(F.struct("sku_root_id", m))).alias(label),
            )
        )
    return reduce(lambda a, b: a.join(b, [*keys, "percentile_rank_inc"], "full"), frames)


def section_totals(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Incremental totals of a root under its section and under its category."""
    zero = F.lit(0).cast(RATE)
    sums = rows.groupBy("sku_root_id").agg(
        *[F.sum(F.coalesce(F.col(m), zero)).cast(RATE).alias(m.replace("inc_", "incremental_")) for m in INCREMENTS]
    ).join(roots.select("sku_root_id", "section", "category"), "sku_root_id")
    both = F.explode(F.array("section", "category")).alias("sec_cat")
    return sums.select(both, "sku_root_id", *[m.replace("inc_", "incremental_") for m in INCREMENTS])


def pareto_section_sku(rows: DataFrame, roots: DataFrame) -> DataFrame:
    labels = {"incremental_margin_amt": "margin", "incremental_sale_amt": "sale", "incremental_sale_qty": "qty"}
    return pareto(section_totals(rows, roots), ["sec_cat"], labels)


def pareto_sku_table(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Ranks per root with descriptions, straight from the ranked rows."""
    ranks = {"incremental_margin_amt": "margin_rank", "incremental_sale_amt": "sale_rank", "incremental_sale_qty": "qty_rank"}
    table = pareto_ranks(section_totals(rows, roots), ["sec_cat"], ranks)
    named = table.withColumnsRenamed({m.replace("inc_", "incremental_"): m for m in INCREMENTS})
    about = roots.select("sku_root_id", "description", "section", "category", "subcategory", "segment")
    return named.join(about, "sku_root_id", "left")


def promo_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("promo_id", "promo_year", "sku_root_id").agg(
        *[F.sum(m).cast(RATE).alias(m) for m in INCREMENTS]
    )


def pareto_promo(rows: DataFrame) -> DataFrame:
    labels = {"inc_margin_amt": "margin", "inc_sale_amt": "sale", "inc_sale_qty": "qty"}
    return pareto(promo_totals(rows), ["promo_id", "promo_year"], labels)


def pareto_promo_table(rows: DataFrame, campaigns: DataFrame, roots: DataFrame) -> DataFrame:
    ranks = {"inc_margin_amt": "margin_rank", "inc_sale_amt": "sale_rank", "inc_sale_qty": "qty_rank"}
    table = pareto_ranks(promo_totals(rows), ["promo_id", "promo_year"], ranks)
    discount = rows.groupBy("promo_id", "promo_year", "sku_root_id").agg(F.sum("tt_discount").cast(RATE).alias("discount"))
    about = campaigns.select(
        "promo_id", F.col("promo_year").cast("string").alias("promo_year"), "name", "start_date", "end_date",
        (F.datediff("end_date", "start_date") + 1).alias("duration"),
        F.month("start_date").alias("st_date_month"),
    )
    skus = roots.select("sku_root_id", "description", "area", "section", "category", "subcategory", "segment")
    return (
        table.join(discount, ["promo_id", "promo_year", "sku_root_id"])
        .join(about, ["promo_id", "promo_year"])
        .join(skus, "sku_root_id")
    )
