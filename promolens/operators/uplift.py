"""Day-of-week counterfactuals and the uplift of offers during and after a promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_name
from ..functions.numeric import MONEY, RATE, fixed, mean_of, rate_sum, ratio
from ..functions.ranking import with_cume_dist
from .facts import PAIR, PROMO
from .promo_facts import ALLOCATED
from .sales import OFFER_MEASURES

OFFER = ["promo_mechanic", "promo_mechanic_description", "discount_depth", "discount_depth_rank"]


def active_period(daily_fact: DataFrame) -> DataFrame:
    """First and last day with sales of a root and store, and the days between."""
    sold = daily_fact.where(F.col("total_sale_qty") != 0)
    return sold.groupBy(*PAIR).agg(F.min("date").alias("start_date"), F.max("date").alias("end_date")).withColumn(
        "period", F.datediff("end_date", "start_date") + 1
    )


def avg_per_day(daily_fact: DataFrame, periods: DataFrame) -> DataFrame:
    sums = daily_fact.groupBy(*PAIR).agg(F.sum("total_sale_qty").cast(MONEY).alias("_qty"))
    return sums.join(periods, PAIR).select(*PAIR, fixed(ratio("_qty", "period")).alias("avg_sale_qty"), "period")


def avg_per_weekday(daily_fact: DataFrame, periods: DataFrame) -> DataFrame:
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    rows = daily_fact.select("date", *PAIR, "total_sale_qty").join(periods, PAIR).where(inside)
    return rows.groupBy(*PAIR, day_name("date").alias("dayweek")).agg(
        fixed(mean_of("total_sale_qty")).alias("total_sale_qty"), F.max("period").alias("period")
    )


def attach(target: DataFrame, per_day: DataFrame, per_weekday: DataFrame) -> DataFrame:
    """Both counterfactuals beside every row of a fact; no counterfactual means zero."""
    zero = F.lit(0).cast(RATE)
    by_day = per_day.select(*PAIR, F.col("avg_sale_qty").alias("_all"))
    by_weekday = per_weekday.select(*PAIR, F.col("dayweek").alias("_weekday"), F.col("total_sale_qty").alias("_day"))
    return (
        target.drop("bline_qty_all", "bline_qty_all_day")
        .withColumn("_weekday", day_name("date"))
        .join(by_day, PAIR, "left")
        .join(by_weekday, [*PAIR, "_weekday"], "left")
        .withColumn("bline_qty_all", F.coalesce("_all", zero))
        .withColumn("bline_qty_all_day", F.coalesce("_day", zero))
        .drop("_weekday", "_all", "_day")
    )


def cume_filter(promo: DataFrame, least: float = 0.1) -> DataFrame:
    """Stores of a root from ``least`` upwards in the order of their counterfactual."""
    pairs = promo.select(*PAIR, "bline_qty_all").distinct()
    return with_cume_dist(pairs, ["sku_root_id"], "bline_qty_all", "cum_dist").where(F.col("cum_dist") >= least)


def keep_pairs(target: DataFrame, pairs: DataFrame, count: str | None = None) -> DataFrame:
    """Rows of the kept roots and stores; with ``count`` only days with one promotion and one offer."""
    kept = target.join(pairs.select(*PAIR).distinct(), PAIR, "left_semi")
    return kept if count is None else kept.where((F.col(count) <= 1) & (F.col("n_promo_mech") == 1))


def segment_residuals(daily_lined: DataFrame, roots: DataFrame) -> DataFrame:
    """Daily sales against both counterfactuals per store and segment."""
    levels = ["area", "section", "category", "subcategory", "segment"]
    rows = daily_lined.join(roots.select("sku_root_id", *levels), "sku_root_id")
    sums = rows.groupBy("store_id", *levels, "date").agg(
        *[F.sum(c).cast(RATE).alias(c) for c in ("total_sale_amt", "total_sale_qty", "total_margin_amt")],
        F.max("promo_flag").alias("promo_flag"),
        *[F.sum(c).cast(RATE).alias(c) for c in ("bline_qty_all", "bline_qty_all_day")],
    )
    qty = F.col("total_sale_qty")
    return sums.withColumns({
        "residuals_bline_qty": (qty - F.col("bline_qty_all")).cast(RATE),
        "residuals_bline_qty_day": (qty - F.col("bline_qty_all_day")).cast(RATE),
    })


def _weeks(campaigns: DataFrame) -> DataFrame:
    days = F.datediff("end_date", "start_date") + 1
    # Only whole durations of one to four weeks are profiled.
    weeks = F.when(days.isin(7, 14, 21, 28), (days / 7).cast("int"))
    return campaigns.select(*PROMO, "start_date", "end_date", weeks.alias("duration_week")).where(
        F.col("duration_week").isNotNull()
    )


def uplift_profile(promo: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Incremental quantity by day since the start of the promotion."""
    rows = promo.join(_weeks(campaigns), PROMO).withColumns({
        "inc_sale_qty": (F.col("total_sale_qty") - F.col("bline_qty_all_day")).cast(RATE),
        "n_days_since_promo_start": F.datediff("date", "start_date") + 1,
    })
    key = ["sku_root_id", *OFFER, "n_days_since_promo_start", "duration_week", "in_gondola_flag", "in_leaflet_flag"]
    sums = rows.groupBy(*key).agg(
        *[rate_sum(c).alias(f"sum_{c}") for c in ("total_sale_qty", "bline_qty_all_day", "inc_sale_qty")]
    )
    return sums.withColumn("avg_perc_inc_sale_qty", ratio("sum_inc_sale_qty", "sum_bline_qty_all_day"))


def without_repromoted(post: DataFrame, within: list[str] = ()) -> DataFrame:
    """Drop roots and stores that were on promotion again in the days after, anywhere or ``within`` the same keys."""
    pair = [*PAIR, *within]
    again = post.where(F.col("pf_promo_flag") == 1).select(*pair).distinct()
    return post.join(again, pair, "left_anti")


def post_profile(post: DataFrame, campaigns: DataFrame, exclude_repromoted: bool = False, within: list[str] = ()) -> DataFrame:
    """Incremental quantity by day since the end of the promotion."""
    rows = (without_repromoted(post, within) if exclude_repromoted else post).join(_weeks(campaigns), PROMO)
    gain = (F.col("pf_sale_qty") - F.col("bline_qty_all_day")).cast(RATE)
    rows = rows.withColumns({
        "inc_pf_sale_qty": gain,
        "perc_inc_pf_sale_qty": fixed(ratio(gain, "bline_qty_all_day")),
        "n_days_since_promo_end": F.datediff("date", "end_date") + 1,
    })
    key = ["sku_root_id", *OFFER, "n_days_since_promo_end", "duration_week", "in_gondola_flag"]
    summed = ["pf_sale_qty", "bline_qty_all_day", "inc_pf_sale_qty"]
    out = rows.groupBy(*key).agg(
        *[rate_sum(c).alias(f"sum_{c}") for c in summed],
        *[mean_of(c).alias(f"avg_{c}") for c in summed],
        mean_of("perc_inc_pf_sale_qty").alias("avg_perc_inc_sale_qty"),
    )
    if exclude_repromoted:
        out = out.withColumn("perc_inc_sale_qty", ratio("sum_inc_pf_sale_qty", "sum_bline_qty_all_day"))
    return out


def coverage(daily_fact: DataFrame, periods: DataFrame, min_days: int = 700) -> DataFrame:
    """Sales of the roots and stores that were active for longer than ``min_days``."""
    long_lived = periods.where(F.col("period") > min_days)
    return daily_fact.join(long_lived.select(*PAIR), PAIR, "left_semi").agg(
        F.sum("total_sale_amt").alias("total_sale_amt"), F.sum("total_sale_qty").alias("total_sale_qty")
    )


def weeks_of(duration: Column) -> Column:
    return F.greatest(F.lit(1.0), F.round(duration / 7))


def promo_totals(promo: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per promotion, root and offer: the input of the uplift models."""
    length = campaigns.select(
        *PROMO, weeks_of(F.datediff("end_date", "start_date") + 1).alias("duration_wks")
    )
    key = [*PROMO, "sku_root_id", *OFFER, "in_leaflet_flag", "in_gondola_flag"]
    sums = promo.groupBy(*key).agg(
        *[rate_sum(m).alias(m) for m in [*ALLOCATED, *OFFER_MEASURES]],
        rate_sum("bline_qty_all_day").alias("total_counterfactual_qty"),
        F.max("promo_prev_week").alias("promo_prev_week"),
        F.max("promo_pf_week").alias("promo_pf_week"),
    )
    gain = F.col("total_sale_qty") - F.col("total_counterfactual_qty")
    return sums.withColumn("total_inc_qty", gain.cast(RATE)).withColumn(
        "perc_inc_qty", ratio("total_inc_qty", "total_counterfactual_qty")
    ).join(length, PROMO)


def example_categories(
    totals: DataFrame, areas: list[str], sections: list[str], categories: list[str], mechanics: list[str]
) -> DataFrame:
    """Totals of chosen hierarchy nodes and mechanics that have a depth."""
    return totals.where(
        F.col("area").isin(areas) & F.col("section").isin(sections) & F.col("category").isin(categories)
        & F.col("promo_mechanic").isin(mechanics) & F.col("discount_depth").isNotNull()
    )
