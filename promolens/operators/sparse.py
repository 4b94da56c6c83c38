"""Daily facts without their zero days: rows that carry something, and runs of days that do not.

A dense fact has a row for every calendar day of every root and store. Here only days with a sale or an offer are
rows; the days between them are runs (root, store, first day, last day). Weekly facts, averages and summaries come
from the two without writing the zero days, and ``dense`` gives them back where they are wanted as rows.

Offers and sales must come from the same campaigns, as they do in the mart: a sale under an offer on a day that the
campaign does not cover would leave out the plain zero row that the dense form has beside it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_name, each_day, week_start
from ..functions.numeric import MONEY, RATE, fixed, ratio
from . import facts
from .facts import PAIR, PROMO, UNIT
from .sales import MEASURES

# A Monday, to name the days of a week by.
_MONDAY = dt.date(2018, 1, 1)


def _bounds(cal: DataFrame) -> tuple[Column, Column]:
    ends = cal.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return ends.select("a").scalar(), ends.select("b").scalar()


def carrying_rows(actuals: DataFrame, root_days: DataFrame, cal: DataFrame) -> DataFrame:
    """Days of a root and store with a sale or an offer, one row per offer, with the day's number of offers."""
    first, last = _bounds(cal)
    sold = actuals.select(*PAIR).distinct()
    offered = root_days.where(F.col("date").between(first, last)).join(sold, PAIR, "left_semi")
    return facts.gap_fill(offered.select("date", *PAIR, *PROMO), actuals)


def zero_runs(rows: DataFrame, cal: DataFrame) -> DataFrame:
    """Longest spans of calendar days of a root and store without any row.

    The window holds the days of one root and store, at most as many as the calendar has.
    """
    first, last = _bounds(cal)
    days = Window.partitionBy(*PAIR).orderBy("date")
    marked = rows.select(*PAIR, "date").distinct().select(
        *PAIR, "date", F.lag("date").over(days).alias("_before"), F.lead("date").over(days).alias("_after"), first.alias("_first"), last.alias("_last"))
    head = F.when(F.col("_before").isNull(), F.struct(F.col("_first").alias("first_day"), F.date_sub("date", 1).alias("last_day")))
    tail = F.struct(F.date_add("date", 1).alias("first_day"), F.coalesce(F.date_sub("_after", 1), "_last").alias("last_day"))
    return marked.select(*PAIR, F.inline(F.filter(F.array(head, tail), lambda r: r.isNotNull() & (r["first_day"] <= r["last_day"]))))


def _zero_rows(keys: DataFrame, like: DataFrame) -> DataFrame:
    """Rows of a date, root and store without sales and offers, in the columns of ``like``."""
    fill = {m: F.lit(0).cast(MONEY) for m in MEASURES} | {"n_promo": F.lit(0).cast("long"), "promo_flag": F.lit(0)}
    kinds = {f.name: f.dataType for f in like.schema.fields}
    return keys.select(*[
        F.col(c) if c in ("date", *PAIR) else fill.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in like.columns
    ])


def dense(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Every calendar day as a row again."""
    days = runs.select(*PAIR, each_day("first_day", "last_day").alias("date"))
    return rows.unionByName(_zero_rows(days, rows))


def weekly_promo(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Weekly sums by offer. A week inside a run is a row as it is; only weeks that a run cuts are added up with sales."""
    begin, end = F.col("first_day"), F.col("last_day")
    first_whole = week_start(F.date_add(begin, 6))
    last_whole = F.date_sub(week_start(F.date_add(end, 1)), 7)
    whole = runs.where(first_whole <= last_whole).select(
        *PAIR, F.explode(F.sequence(first_whole, last_whole, F.expr("interval 7 days"))).alias("date"))
    cut = F.array_distinct(F.filter(
        F.array(F.when(week_start(begin) != begin, week_start(begin)), F.when(F.date_add(week_start(end), 6) != end, week_start(end))),
        lambda d: d.isNotNull()))
    parts = runs.select(*PAIR, F.explode(cut).alias("date"))
    summed = facts.weekly_promo(rows.unionByName(_zero_rows(parts, rows)))
    return summed.unionByName(_zero_rows(whole, summed).withColumn("no_days_with_promo", F.lit(0).cast(summed.schema["no_days_with_promo"].dataType)))


def daily(rows: DataFrame) -> DataFrame:
    """One row per carrying date, root and store."""
    return facts.daily(rows)


def daily_summary(day_rows: DataFrame, cal: DataFrame) -> DataFrame:
    """Totals over stores for every calendar day of a root; zero rows are added per root, not per store."""
    first, last = _bounds(cal)
    roots = day_rows.select("sku_root_id").distinct()
    days = roots.select("sku_root_id", F.lit(None).cast("string").alias("store_id"), each_day(first, last).alias("date"))
    return facts.summary(day_rows.unionByName(_zero_rows(days, day_rows)))


def avg_per_weekday(day_rows: DataFrame, periods: DataFrame) -> DataFrame:
    """Mean units of a weekday between the first and the last sale; how often the weekday occurs there is counted from the dates."""
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    kept = day_rows.select("date", *PAIR, "total_sale_qty").join(periods, PAIR).where(inside)
    sums = kept.groupBy(*PAIR, F.weekday("date").alias("_day")).agg(F.sum("total_sale_qty").alias("_qty"))
    first = F.date_add("start_date", F.pmod(F.col("_day") - F.weekday("start_date"), F.lit(7)))
    times = F.floor(F.datediff("end_date", first) / 7) + 1
    slots = periods.withColumn("_day", F.explode(F.sequence(F.lit(0), F.lit(6)))).withColumn("_times", times).where("_times > 0")
    total = F.coalesce("_qty", F.lit(0).cast(RATE))
    return slots.join(sums, [*PAIR, "_day"], "left").select(
        *PAIR, day_name(F.date_add(F.lit(_MONDAY), F.col("_day"))).alias("dayweek"), fixed(ratio(total, "_times")).alias("total_sale_qty"), "period")
