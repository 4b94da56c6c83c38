"""Expected sales of a promotion had it not run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.folds import fold_rows
from ..functions.numeric import MONEY, cents, dbl, ratio
from .facts import with_root

ID_FIELDS = ["uniq_id", "sku_root_id", "promo_id", "promo_year", "promo_mechanic", "discount_depth"]


def scope(df: DataFrame, area: str | None = None, section: str | None = None) -> DataFrame:
    if area is not None:
        df = df.where(F.col("area") == area)
    if section is not None:
        df = df.where(F.col("section") == section)
    return df


def sections(roots: DataFrame, area: str | None = None) -> DataFrame:
    return scope(roots, area).select("area", "section").distinct()


def promo_weeks(
    promo_summary: DataFrame, roots: DataFrame, level: str = "section", area: str | None = None,
    require_neighbours: bool = True,
) -> DataFrame:
    """Weekly promo rows in scope with their promotion id.

    ``require_neighbours=False`` takes a summary that was filtered beforehand.
    """
    rows = scope(with_root(promo_summary, roots, ["area", "section", "category", "subcategory", "segment"]), area)
    if require_neighbours:
        rows = rows.where(F.col("s_prev_bl_qty").isNotNull() & F.col("pf_after_bl_qty").isNotNull())
    dash = F.lit("-")
    year = F.col("promo_year").cast("string")
    uniq = F.concat(
        "sku_root_id", dash, "promo_id", dash, year, dash, "promo_mechanic", dash,
        F.coalesce("discount_depth", F.lit("ISNULL")),
    )
    parts = dict.fromkeys(["section", level])
    return rows.select(
        "date", uniq.alias("uniq_id"), *parts, "sku_root_id", "promo_id", year.alias("promo_year"),
        "promo_mechanic", "discount_depth", "total_sale_qty", "s_prev_bl_qty", "pf_after_bl_qty",
    )


def unpromoted_sales(
    weekly_fact: DataFrame, roots: DataFrame, level: str = "section", area: str | None = None
) -> DataFrame:
    rows = weekly_fact.where(F.col("promo_flag") == 0).select("date", "sku_root_id", "total_sale_qty")
    totals = rows.groupBy("date", "sku_root_id").agg(F.sum("total_sale_qty").cast(MONEY).alias("sale_qty_np"))
    parts = dict.fromkeys(["section", level])
    return scope(with_root(totals, roots, list(dict.fromkeys(["area", *parts]))), area).select(
        "date", "sku_root_id", *parts, "sale_qty_np"
    )


def change_index(df: DataFrame, keys: list[str], measure: str, out: str) -> DataFrame:
    """Measure over the previous row's; 1 on the first row, NULL after a zero.

    A key holds one row per week, so the window stays short.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    index = F.when(F.row_number().over(w) == 1, F.lit(1.0)).otherwise(ratio(F.col(measure), F.lag(measure).over(w)))
    return df.withColumn(out, index)


def level_trend(unpromoted: DataFrame, level: str = "section") -> DataFrame:
    keys = list(dict.fromkeys(["section", level]))
    sums = unpromoted.groupBy("date", *keys).agg(F.sum("sale_qty_np").cast(MONEY).alias("sale_qty_np"))
    return change_index(sums, keys, "sale_qty_np", "sale_qty_pct")


def extended_weeks(rows: DataFrame, ext_weeks: int = 4) -> DataFrame:
    """Flag first (1) and later (2) promo weeks and append extension weeks (3)."""
    w = Window.partitionBy("uniq_id").orderBy("date")
    flagged = rows.withColumn("change_flag", F.when(F.row_number().over(w) == 1, 1).otherwise(2))
    copied = [c for c in rows.columns if c not in ("date", "total_sale_qty", "s_prev_bl_qty", "pf_after_bl_qty")]
    last = rows.groupBy("uniq_id").agg(F.max(F.struct("date", *[c for c in copied if c != "uniq_id"])).alias("last"))
    first_day, last_day = F.date_add("last.date", 7), F.date_add("last.date", 7 * ext_weeks)
    weeks = F.explode(F.sequence(first_day, last_day, F.expr("interval 7 days")))
    extra = last.select(
        weeks.alias("date"), "uniq_id", *[F.col(f"last.{c}").alias(c) for c in copied if c != "uniq_id"],
        F.lit(3).alias("change_flag"),
    )
    return flagged.unionByName(extra, allowMissingColumns=True)


def recursive_counterfactual(weeks: DataFrame, trend: DataFrame, level: str = "section") -> DataFrame:
    """Carry the expected quantity from week to week, rounded at every step."""
    keys = list(dict.fromkeys(["section", level]))
    rows = weeks.join(trend.select("date", *keys, "sale_qty_pct"), ["date", *keys]).select(
        *ID_FIELDS, "date", "change_flag", "total_sale_qty",
        dbl("s_prev_bl_qty").alias("prev"), dbl("pf_after_bl_qty").alias("after"), "sale_qty_pct",
    )

    def step(acc: Column, row: Column) -> dict[str, Column]:
        flag, pct = row["change_flag"], row["sale_qty_pct"]
        carried = acc["bl"] * pct
        bl = (
            F.when(flag == 1, row["prev"] * pct)
            .when(flag == 2, carried)
            .when(acc["flag"].isin(1, 2), acc["after"])
            .when(acc["flag"] == 3, carried)
        )
        return {"flag": flag, "after": row["after"], "bl": cents(bl), "sale_qty_bl": cents(bl)}

    folded = fold_rows(
        rows, ID_FIELDS, "date", ["change_flag", "total_sale_qty", "prev", "after", "sale_qty_pct"],
        {"flag": "int", "after": "double", "bl": "double"}, step, {"sale_qty_bl": "double"},
    )
    return folded.select(
        "date", *ID_FIELDS, "change_flag", "total_sale_qty", "sale_qty_bl", "sale_qty_pct"
    )


def promo_counterfactual(
    promo_summary: DataFrame, weekly_fact: DataFrame, roots: DataFrame, level: str = "section",
    area: str | None = None, ext_weeks: int = 4, require_neighbours: bool = True,
) -> DataFrame:
    """All sections in one job; ``area`` narrows the scope."""
    rows = promo_weeks(promo_summary, roots, level, area, require_neighbours)
    trend = level_trend(unpromoted_sales(weekly_fact, roots, level, area), level)
    return recursive_counterfactual(extended_weeks(rows, ext_weeks), trend, level)


METRICS = ["sale_amt", "sale_qty", "margin_amt"]


def weekly_sku_counterfactual(
    weekly_fact: DataFrame, roots: DataFrame, level: str = "section", ext_weeks: int = 1
) -> DataFrame:
    """Weekly counterfactual of a root over all stores, the input of cannibalisation and forecast.

    A week counts as promoted when more than half of the root's stores are. Flags: 0
    none, 1 first promoted week, 2 later ones, 3 the ``ext_weeks`` after.
    """
    totals = weekly_fact.groupBy("date", "sku_root_id").agg(
        *[F.sum(f"total_{m}").cast(MONEY).alias(f"total_{m}") for m in METRICS],
        F.when(F.sum("promo_flag") * 2 > F.count(F.lit(1)), 1).otherwise(0).alias("promo_flag_binary"),
        *[F.sum(F.when(F.col("promo_flag") == 0, F.col(f"total_{m}"))).cast(MONEY).alias(f"np_{m}") for m in METRICS],
    )
    rows = with_root(totals, roots, list(dict.fromkeys(["section", "segment", level])))
    trend = rows.groupBy("date", level).agg(
        *[F.coalesce(F.sum(f"np_{m}"), F.lit(0)).cast(MONEY).alias(f"np_{m}") for m in METRICS]
    )
    for m in METRICS:
        trend = change_index(trend, [level], f"np_{m}", f"{m}_pct")
    w = Window.partitionBy("sku_root_id").orderBy("date")
    on = F.col("promo_flag_binary") == 1
    last_on = F.last(F.when(on, F.col("date")), ignorenulls=True).over(w)
    recent = F.datediff("date", last_on) <= 7 * ext_weeks
    flag = (
        F.when(on & (F.coalesce(F.lag("promo_flag_binary").over(w), F.lit(0)) == 0), 1)
        .when(on, 2)
        .when(F.coalesce(recent, F.lit(False)), 3)
        .otherwise(0)
    )
    flagged = rows.join(trend.select("date", level, *[f"{m}_pct" for m in METRICS]), ["date", level])
    flagged = flagged.withColumn("change_flag", flag)
    for m in METRICS:
        flagged = flagged.withColumn(f"t_{m}", dbl(f"total_{m}"))

    def step(acc: Column, row: Column) -> dict[str, Column]:
        state: dict[str, Column] = {}
        for m in METRICS:
            start = F.coalesce(acc[f"t_{m}"], row[f"t_{m}"])
            bl = (
                F.when(row["change_flag"] == 1, start * row[f"{m}_pct"])
                .when(row["change_flag"].isin(2, 3), acc[f"b_{m}"] * row[f"{m}_pct"])
            )
            state[f"t_{m}"] = row[f"t_{m}"]
            state[f"b_{m}"] = cents(bl)
            state[f"{m}_bl"] = F.when(row["change_flag"].isin(1, 2), cents(bl))
            state[f"{m}_bl_ext"] = F.when(row["change_flag"] == 3, cents(bl))
        return state

    keys = list(dict.fromkeys(["sku_root_id", "section", "segment", level]))
    fields = ["promo_flag_binary", "change_flag", *[f"{m}_pct" for m in METRICS],
              *[f"total_{m}" for m in METRICS], *[f"t_{m}" for m in METRICS]]
    carried = {f"{p}_{m}": "double" for m in METRICS for p in ("t", "b")}
    outputs = {f"{m}_{s}": "double" for m in METRICS for s in ("bl", "bl_ext")}
    folded = fold_rows(flagged, keys, "date", fields, carried, step, outputs)
    gain = F.when(on, F.coalesce(F.col("t_sale_qty") - F.col("sale_qty_bl"), F.lit(0.0))).otherwise(0.0)
    return folded.withColumn("incremental_qty", gain).drop(*[f"t_{m}" for m in METRICS])
