"""Price elasticity from grouped regressions of quantity on price.

Regressions are built from sums, so a large product or store is added up in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.numeric import MONEY, dbl, fixed, mean_of, ratio

LINE = ["sku_root_id", "store_id"]


def line_fit(x: str, y: str) -> dict[str, Column]:
    """Slope, intercept and R2 of y on x; a constant x gives slope 0 and the mean."""
    slope, flat = F.regr_slope(dbl(y), dbl(x)), F.avg(dbl(y))
    constant_y = F.coalesce(F.var_pop(dbl(y)) == 0, F.lit(False))
    r2 = F.coalesce(F.regr_r2(dbl(y), dbl(x)), F.when(constant_y, 1.0).otherwise(0.0))
    return {
        "coeficient": F.coalesce(slope, F.lit(0.0)),
        "intercept": F.coalesce(F.regr_intercept(dbl(y), dbl(x)), flat),
        "R2": F.when(constant_y, 1.0).otherwise(r2),
    }


def price_points(
    daily_fact: DataFrame, roots: DataFrame, qty_agg: str = "sum", areas: list[str] | None = None,
    category: str | None = None, stores: DataFrame | None = None, skip_month: int = 12, tolerance: float = 0.1,
) -> DataFrame:
    """Mean weekly quantity of a root and store at every list price, outside promotions."""
    rows = daily_fact.where((F.col("promo_flag") == 0) & (F.col("total_sale_qty") != 0))
    scope = roots.select("sku_root_id", "area", "category")
    if areas is not None:
        scope = scope.where(F.col("area").isin(areas))
    if category is not None:
        scope = scope.where(F.col("category") == category)
    rows = rows.join(scope.select("sku_root_id"), "sku_root_id", "left_semi")
    if stores is not None:
        rows = rows.join(stores.select("store_id"), "store_id", "left_semi")
    price = "std_price_per_unit"
    quantity = dbl(F.sum("total_sale_qty")) if qty_agg == "sum" else mean_of("total_sale_qty")
    weeks = rows.groupBy(*LINE, week_start("date").alias("week_start_date"), price).agg(
        fixed(quantity).alias("qty"),
        fixed(ratio(F.sum("total_sale_amt").cast(MONEY), F.sum("total_sale_qty").cast(MONEY))).alias("paid"),
    )
    near = ratio(F.abs(F.col("paid") - F.col(price)), price) < tolerance
    return weeks.where((F.month("week_start_date") != skip_month) & near).groupBy(*LINE, price).agg(
        fixed(mean_of("qty")).alias("avg_sales_qty"),
        fixed(mean_of("paid")).alias("actual_price"),
        F.count("week_start_date").alias("duration_weeks"),
        F.stddev_samp(dbl("qty")).alias("std_dev_sales_qty"),
    )


def unit_cost(prices: DataFrame, skus: DataFrame, category: str | None = None) -> DataFrame:
    cats = skus.select("sku_root_id", "category").distinct()
    if category is not None:
        cats = cats.where(F.col("category") == category)
    return prices.select("sku_root_id", "cost_per_unit").join(cats, "sku_root_id").distinct()


def _one_cost(cost: DataFrame) -> DataFrame:
    return cost.groupBy("sku_root_id").agg(F.min("cost_per_unit").alias("cost_per_unit"))


def store_regression(points: DataFrame, cost: DataFrame) -> DataFrame:
    """One line per root and store: quantity on list price."""
    fits = points.groupBy(*LINE).agg(
        *[c.alias(n) for n, c in line_fit("std_price_per_unit", "avg_sales_qty").items()],
        mean_of("avg_sales_qty").alias("Nfactor"),
        F.count(F.lit(1)).alias("points"),
        mean_of("actual_price").alias("avg_price"),
    )
    return fits.withColumn("gradient", ratio("coeficient", "Nfactor")).join(_one_cost(cost), "sku_root_id", "left")


def sku_elasticity(points: DataFrame, lines: DataFrame, min_points: int = 2) -> DataFrame:
    """Root summary over the stores whose gradient is at or below the mean negative one."""
    falling = lines.where((F.col("coeficient") < 0) & (F.col("points") > min_points)).withColumn("g", fixed("gradient"))
    mean = falling.groupBy("sku_root_id").agg(mean_of("g").alias("mean_gradient"))
    steep = falling.join(mean, "sku_root_id").where(F.col("gradient") <= F.col("mean_gradient"))
    about = steep.groupBy("sku_root_id").agg(
        mean_of("g").alias("gradient"),
        mean_of(fixed("R2")).alias("R2"),
        F.stddev_samp("gradient").alias("std"),
        F.count_distinct("store_id").alias("store_count"),
        F.min("cost_per_unit").alias("cost_per_unit"),
    )
    usual = points.groupBy("sku_root_id").agg(
        mean_of("avg_sales_qty").alias("avg_qty"), mean_of("actual_price").alias("average_price")
    )
    g, i, p = F.col("gradient"), F.col("intercept"), F.col("average_price")
    return (
        about.join(usual, "sku_root_id")
        .withColumn("m", g * F.col("avg_qty"))
        .withColumn("intercept", 1 - g * p)
        .withColumn("Pmax", ratio(-i, g))
        .withColumn("optimal_price", ratio(i - g * dbl("cost_per_unit"), -g * 2))
        .withColumn("percentage_change", ratio(F.col("optimal_price") - p, p))
        .drop("avg_qty")
    )


def sku_elasticity_groups(
    lines: DataFrame, min_points: int = 2, store_share: float = 0.1, r2: float = 0.6,
    max_change: float = 0.3, literal: bool = False,
) -> DataFrame:
    """Best of two store groups: all falling lines, and those with a strong fit.

    ``literal=True`` keeps an oddity of the original scripts, where both groups are
    the strong one and no limit on the price change applies.
    """
    total = lines.groupBy("sku_root_id").agg(F.count(F.lit(1)).alias("total_stores"))
    falling = lines.where((F.col("points") > min_points) & (F.col("gradient") < 0))
    strong = F.col("R2") >= r2

    def group(name: str, test: Column) -> list[Column]:
        def mean(c: str) -> Column:
            return mean_of(F.when(test, fixed(c)))

        return [
            F.count_if(test).alias(f"{name}_stores"),
            mean("gradient").alias(f"{name}_gradient"), mean("R2").alias(f"{name}_R2"),
            mean("avg_price").alias(f"{name}_price"), mean("cost_per_unit").alias(f"{name}_cost"),
            mean("Nfactor").alias(f"{name}_factor"),
        ]

    sums = falling.groupBy("sku_root_id").agg(
        *group("all", strong if literal else F.lit(True)), *group("strong", strong)
    ).join(total, "sku_root_id")
    built = {}
    for n in ("all", "strong"):
        g, p = F.col(f"{n}_gradient"), F.col(f"{n}_price")
        optimal = ratio(1 - g * (p + F.col(f"{n}_cost")), -2 * g)
        built[n] = F.struct(
            g.alias("avg_gradient"), F.col(f"{n}_R2").alias("avg_R2"),
            (F.col(f"{n}_factor") - g * p).alias("intercept"),
            optimal.alias("optimal_price"), (ratio(optimal, p) - 1).alias("percentage_change"),
            ratio(f"{n}_stores", "total_stores").alias("store_percentage"),
        )
    a, s = F.col("a"), F.col("s")
    wide_a = a["store_percentage"] > store_share
    wide_s = s["store_percentage"] > store_share
    narrow_a = a["store_percentage"] < store_share
    narrow_s = s["store_percentage"] < store_share
    da, ds = a["percentage_change"], s["percentage_change"]
    choice = (
        F.when(
            wide_a & wide_s,
            F.when((da <= max_change) & (da < ds), a).when((ds <= max_change) & (ds < da), s).when(da == ds, s),
        )
        .when(wide_a & narrow_s & (da <= max_change), a)
        .when(wide_s & narrow_a & (ds <= max_change), s)
    )
    return (
        sums.select("sku_root_id", built["all"].alias("a"), built["strong"].alias("s"))
        .select("sku_root_id", choice.alias("c"))
        .where(F.col("c").isNotNull())
        .select(F.col("sku_root_id").alias("sku_id"), "c.*")
    )


def sku_pooled(
    points: DataFrame, cost: DataFrame, min_weeks: int = 3, min_points: int = 2, spread: float = 2.0
) -> DataFrame:
    """One pooled line per root over normalised quantities of its falling stores."""
    kept = points.where(F.col("duration_weeks") >= min_weeks)
    fits = kept.groupBy(*LINE).agg(
        line_fit("std_price_per_unit", "avg_sales_qty")["coeficient"].alias("slope"),
        mean_of("avg_sales_qty").alias("norm_factor"),
        F.count(F.lit(1)).alias("n"),
    ).where((F.col("n") > max(2, min_points)) & (ratio("slope", "norm_factor") < 0))
    rows = kept.join(fits.select(*LINE, "norm_factor"), LINE).withColumn(
        "avg_qty_norm", fixed(ratio("avg_sales_qty", "norm_factor"))
    )
    limits = rows.groupBy("sku_root_id").agg(
        mean_of("avg_qty_norm").alias("mid"), F.stddev_samp(dbl("avg_qty_norm")).alias("sd")
    )
    away = F.abs(dbl("avg_qty_norm") - F.col("mid"))
    inside = rows.join(limits, "sku_root_id").where(F.col("sd").isNull() | (away <= spread * F.col("sd")))
    usual = inside.groupBy(*LINE).agg(mean_of("std_price_per_unit").alias("usual_price"))
    ready = inside.join(usual, LINE).withColumn("price_norm", fixed(ratio("std_price_per_unit", "usual_price")))
    paid, listed = line_fit("actual_price", "avg_qty_norm"), line_fit("price_norm", "avg_qty_norm")
    return (
        ready.groupBy("sku_root_id")
        .agg(
            *[c.alias(n) for n, c in paid.items()],
            *[c.alias(f"{n}_std") for n, c in listed.items()],
            F.max("price_norm").alias("max_price"),
            F.min("price_norm").alias("min_price"),
            F.count_distinct("store_id").alias("store_count"),
            F.count(F.lit(1)).alias("point_count"),
        )
        .where(F.col("point_count") > 3)
        .join(_one_cost(cost), "sku_root_id", "left")
    )
