"""Dense daily and weekly facts per root product and store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import each_day, week_start
from ..functions.joins import spread_missing
from ..functions.numeric import MONEY, RATE, fixed, mean_of, money_sum, ratio
from .sales import MEASURES, OFFER_MEASURES, PLAIN_MEASURES

PAIR = ["sku_root_id", "store_id"]
PROMO = ["promo_id", "promo_year"]
UNIT = "std_price_per_unit"
ROOT_ATTRIBUTES = [
    "description", "area", "section", "category", "subcategory", "segment",
    "brand_name", "own_brand_flag", "own_brand_label",
]
SUMMARY_MEASURES = [
    "total_sale_amt", "total_sale_qty", "total_margin_amt", "total_price_if_sku_std_price",
    "total_non_oferta_discount_amt", "total_non_oferta_discount_amt_ex_vale", *OFFER_MEASURES,
]


def with_root(df: DataFrame, roots: DataFrame, columns: list[str] = ROOT_ATTRIBUTES) -> DataFrame:
    """Attach root attributes after aggregation, so no shuffle carries them."""
    return df.join(roots.select("sku_root_id", *columns), "sku_root_id")


def promo_windows(promo_to_sku: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Roots and stores of every campaign with the campaign's first and last day."""
    offered = promo_to_sku.select(*PAIR, *PROMO).distinct()
    return offered.join(campaigns.select(*PROMO, "start_date", "end_date"), PROMO)


def promo_root_days(promo_to_sku: DataFrame, days: DataFrame) -> DataFrame:
    """Roots and stores on offer, day by day."""
    offered = promo_to_sku.select(*PAIR, *PROMO).distinct()
    return days.join(offered, PROMO).select("date", *PAIR, *PROMO)


def daily_root_promo(trans: DataFrame, roots: DataFrame, windows: DataFrame) -> DataFrame:
    """Daily sums per root, store and offer; an offer counts only on its own days.

    Whether an offer is live depends on its code and the day only, so tickets are summed by code and day before
    they meet the campaigns: the join sees days, not ticket lines.
    """
    active = windows.select(
        F.col("promo_id").alias("_code"), F.col("promo_year").alias("_year"), *PAIR, *PROMO, "start_date", "end_date"
    )
    booked = trans.join(roots.select("sku_root_id"), "sku_root_id", "left_semi").groupBy("date", *PAIR, *PROMO).agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.sum(UNIT).alias("_unit"), F.count(UNIT).alias("_n")
    )
    keyed = (
        booked.withColumn("_code", spread_missing("promo_id", "date", *PAIR))
        .withColumn("_year", F.col("promo_year"))
        .drop(*PROMO)
    )
    t, a = keyed.alias("t"), active.alias("a")
    match = (
        (F.col("t._code") == F.col("a._code"))
        & (F.col("t._year") == F.col("a._year"))
        & (F.col("t.sku_root_id") == F.col("a.sku_root_id"))
        & (F.col("t.store_id") == F.col("a.store_id"))
        & F.col("t.date").between(F.col("a.start_date"), F.col("a.end_date"))
    )
    joined = t.join(a, match, "left").select("t.*", "a.promo_id", "a.promo_year")
    live = F.col("promo_id").isNotNull() & F.col("promo_year").isNotNull()
    return joined.groupBy("date", *PAIR, *PROMO).agg(
        *[money_sum(m).alias(m) for m in PLAIN_MEASURES],
        *[money_sum(F.when(live, F.col(m)).otherwise(F.lit(0).cast(MONEY))).alias(m) for m in OFFER_MEASURES],
        fixed(F.try_divide(F.sum("_unit").cast("double"), F.sum("_n"))).alias(UNIT),
    )


def dense_grid(actuals: DataFrame, cal: DataFrame) -> DataFrame:
    """Every calendar day of every root and store that ever sold."""
    bounds = cal.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = each_day(bounds.select("a").scalar(), bounds.select("b").scalar())
    return actuals.select(*PAIR).distinct().select(*PAIR, days.alias("date"))


def grid_with_promos(grid: DataFrame, root_days: DataFrame) -> DataFrame:
    return grid.join(root_days, ["date", *PAIR], "left")


def gap_fill(grid_promos: DataFrame, actuals: DataFrame) -> DataFrame:
    """Actual sales on the grid, zero where nothing sold, with the day's number of offers.

    Only keys are shuffled for the grid and for the count; the measures join once, at
    the end. Grid days without an offer and actual sales without one share a key.
    """
    key = ["date", *PAIR, *PROMO]
    keys = grid_promos.select(*key).unionByName(actuals.select(*key)).repartition(*PAIR, "date").distinct()
    counted = with_promo_count(keys, ["date", *PAIR])
    sales = actuals.withColumnsRenamed({k: f"_{k}" for k in key})
    same = F.lit(True)
    for k in ["date", *PAIR]:
        same = same & (F.col(k) == F.col(f"_{k}"))
    for k in PROMO:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    zero = F.lit(0).cast(MONEY)
    return counted.join(sales, same, "left").select(
        *key, *[F.coalesce(m, zero).alias(m) for m in MEASURES], UNIT, "n_promo", "promo_flag"
    )


def with_promo_count(df: DataFrame, key: list[str]) -> DataFrame:
    """``n_promo``: offers of the key; a key holds few rows, one per offer."""
    named = F.col("promo_id").isNotNull() & F.col("promo_year").isNotNull()
    n = F.count_if(named).over(Window.partitionBy(*key))
    return df.withColumn("n_promo", n).withColumn("promo_flag", F.when(F.col("n_promo") == 0, 0).otherwise(1))


def _promo_list(name: str) -> Column:
    found = F.sort_array(F.collect_set(name))
    return F.when(F.size(found) > 0, found)


def _collapse(df: DataFrame, extra: list[str]) -> DataFrame:
    """One row per date, root and store.

    A key without offers has a single row already, so only keys with offers are
    shuffled and summed.
    """
    kept = ["date", *PAIR]
    single = df.where(F.col("n_promo") == 0).select(
        *kept,
        F.lit(None).cast("array<string>").alias("promo_id_list"),
        F.lit(None).cast("array<bigint>").alias("promo_year_list"),
        *MEASURES, UNIT, "n_promo", "promo_flag", *extra,
    )
    several = df.where(F.col("n_promo") > 0).groupBy(*kept).agg(
        _promo_list("promo_id").alias("promo_id_list"),
        _promo_list("promo_year").alias("promo_year_list"),
        *[money_sum(m).alias(m) for m in MEASURES],
        fixed(mean_of(UNIT)).alias(UNIT),
        F.max("n_promo").alias("n_promo"),
        F.max("promo_flag").alias("promo_flag"),
        *[F.max(c).alias(c) for c in extra],
    )
    return single.unionByName(several)


def daily(promo_rows: DataFrame) -> DataFrame:
    return _collapse(promo_rows, [])


def weekly_promo(promo_rows: DataFrame) -> DataFrame:
    on_day = F.when(F.col("promo_id").isNotNull(), F.col("promo_flag")).otherwise(0)
    sums = promo_rows.groupBy(week_start("date").alias("date"), *PAIR, *PROMO).agg(
        *[money_sum(m).alias(m) for m in MEASURES],
        fixed(mean_of(UNIT)).alias(UNIT),
        F.sum(on_day).alias("no_days_with_promo"),
    )
    return with_promo_count(sums, ["date", *PAIR])


def weekly(weekly_rows: DataFrame) -> DataFrame:
    return _collapse(weekly_rows, ["no_days_with_promo"])


def summary(fact: DataFrame) -> DataFrame:
    """Totals over stores."""
    return fact.groupBy("date", "sku_root_id").agg(
        F.max("promo_flag").alias("promo_flag"),
        *[money_sum(m).alias(m) for m in SUMMARY_MEASURES],
        fixed(mean_of(UNIT)).alias(UNIT),
    )


def _nonzero(first: Column, second: Column) -> Column:
    return F.when((first == 0) | first.isNull(), second).otherwise(first)


def std_price_margin(trans: DataFrame, daily_fact: DataFrame, roots: DataFrame) -> DataFrame:
    """Usual price, margin and cost of a root, from days and tickets without offers."""

    def level(df: DataFrame, prefix: str) -> DataFrame:
        rows = df.join(roots.select("sku_root_id"), "sku_root_id", "left_semi").select(
            "sku_root_id",
            fixed(ratio("total_margin_amt", "total_sale_qty")).alias("_m"),
            F.col(UNIT).alias("_p"),
            fixed(ratio("total_sale_amt", "total_sale_qty")).alias("_p2"),
        )
        means = rows.groupBy("sku_root_id").agg(
            fixed(mean_of("_m")).alias(f"{prefix}_margin"),
            fixed(mean_of("_p")).alias("_p"),
            fixed(mean_of("_p2")).alias("_p2"),
        )
        return means.select("sku_root_id", f"{prefix}_margin", _nonzero(F.col("_p"), F.col("_p2")).alias(f"{prefix}_price"))

    by_day = level(daily_fact.where(F.col("promo_flag") == 0), "day")
    by_ticket = level(trans.where(F.col("promo_id").isNull()), "ticket")
    return by_day.join(by_ticket, "sku_root_id", "left").select(
        "sku_root_id",
        _nonzero(F.col("day_margin"), F.col("ticket_margin")).alias("margin_per_unit"),
        _nonzero(F.col("day_price"), F.col("ticket_price")).alias(UNIT),
    ).withColumn("cost_per_unit", (F.col(UNIT) - F.col("margin_per_unit")).cast(RATE))
