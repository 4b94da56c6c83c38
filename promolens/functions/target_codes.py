"""Ordered target statistics: a category as the mean target of the rows before it in a seeded order.

A row never sees its own target, so the code does not give it away. Sums before a row are prefix sums over ranges of
(feature, value, order) that Spark samples: a value that a third of all rows share lies in many ranges, and a window
works inside one. New rows get the sums over all training rows by a join; values stay in tables however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .numeric import RATE, dbl, fixed, mean_of


def sums_before(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``n_before`` and ``sum_before`` of the rows that come before in the order of their group; rows equal in ``order`` count by place."""
    parted = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    parted = Workspace(df.sparkSession).keep(parted, "parted")
    totals = parted.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.sum("_s").over(earlier).alias("_s0"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(RATE)
    rows = parted.withColumn("_n1", F.count("*").over(inside)).withColumn("_s1", F.sum(value).over(inside)).join(offsets, same)
    rows = rows.withColumn("n_before", F.col("_n0") + F.col("_n1")).withColumn("sum_before", F.coalesce("_s0", zero) + F.coalesce("_s1", zero))
    return rows.select(*df.columns, "n_before", "sum_before")


def smoothed_mean(total: Column | str, n: Column | str, prior: Column, weight: float) -> Column:
    """Mean pulled to ``prior`` as by ``weight`` rows of it."""
    return (dbl(total) + prior * weight) / (dbl(n) + weight)


def _long(df: DataFrame, columns: list[str], kept: list[str]) -> DataFrame:
    return df.select(*kept, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(kept, columns, "feature", "value")


def ordered_codes(train: DataFrame, columns: list[str], target: str, order: Column, weight: float = 1.0) -> DataFrame:
    """``train`` with each category column replaced by its code; ``order`` is a seeded mark of the row."""
    work = Workspace(train.sparkSession)
    rows = work.keep(train.withColumn("_row", F.monotonically_increasing_id()).withColumn("_mark", order).withColumn("_y", fixed(target)), "rows")
    prior = F.lit(rows.agg(mean_of("_y").alias("mean")).select("mean").scalar())
    before = sums_before(_long(rows, columns, ["_row", "_mark", "_y"]), ["feature", "value"], ["_mark", "_y"], "_y")
    coded = before.select("_row", "feature", smoothed_mean("sum_before", "n_before", prior, weight).alias("code"))
    wide = coded.groupBy("_row").agg(*[F.max(F.when(F.col("feature") == c, F.col("code"))).alias(c) for c in columns])
    return rows.drop(*columns, "_mark", "_y").join(wide, "_row").drop("_row").select(*train.columns)


def category_sums(train: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, value, n, total) over all training rows."""
    rows = _long(train.withColumn("_y", fixed(target)), columns, ["_y"])
    return rows.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("_y").cast(RATE).alias("total"))


def codes_of(df: DataFrame, sums: DataFrame, columns: list[str], prior: float, weight: float = 1.0) -> DataFrame:
    """Category columns replaced by the codes of the training rows; a value without one gets the prior."""
    for c in columns:
        of_column = sums.where(F.col("feature") == c).select(F.col("value").alias("_value"), smoothed_mean("total", "n", F.lit(prior), weight).alias("_code"))
        df = df.join(of_column, F.col(c).cast("string").eqNullSafe(F.col("_value")), "left").withColumn(c, F.coalesce("_code", F.lit(prior))).drop("_value", "_code")
    return df
