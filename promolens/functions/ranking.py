"""Ranks and exact quantiles in groups of any size.

A plain window sorts a whole group in one task. Here equal values are counted first. The counted values are then
range-partitioned by group and value on splitters that Spark samples from them, so a part is as large as
any other however close or far its values lie, and a window works inside a part; the parts' totals give the offsets.
The parts are written before they are numbered, so a recomputed task agrees with the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .numeric import dbl


def value_positions(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per group and distinct value: ``rows_equal``, ``rows_below``, ``rows_total``.

    NULL values sort first, as in an ascending window, NaN last.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("rows_equal"))
    parted = counted.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id())
    counted = Workspace(df.sparkSession).keep(parted, "counted")
    parts = counted.groupBy(*keys, "_part").agg(F.sum("rows_equal").alias("_n"))
    over_parts = Window.partitionBy(*keys)
    parts = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_p"),
        (F.sum("_n").over(over_parts.orderBy("_part")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(over_parts).alias("rows_total"),
    )
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    in_part = Window.partitionBy(*keys, "_part").orderBy(value)
    return (
        counted.withColumn("_before", F.sum("rows_equal").over(in_part) - F.col("rows_equal"))
        .join(parts, same)
        .withColumn("rows_below", F.col("_before") + F.col("_offset"))
        .select(*keys, value, "rows_equal", "rows_below", "rows_total")
    )


def _attach(df: DataFrame, keys: list[str], value: str, out: str, expr: Column) -> DataFrame:
    ranked = value_positions(df, keys, value).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(value).alias("_v"),
        expr.alias(out),
    )
    same = F.col(value).eqNullSafe(F.col("_v"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(ranked, same).drop("_v", *[f"_k{i}" for i in range(len(keys))])


def with_percent_rank(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    spread = F.when(F.col("rows_total") > 1, F.col("rows_below") / (F.col("rows_total") - 1))
    return _attach(df, keys, value, out, spread.otherwise(0.0))


def with_cume_dist(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    share = (F.col("rows_below") + F.col("rows_equal")) / F.col("rows_total")
    return _attach(df, keys, value, out, share)


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str) -> DataFrame:
    """Linear-interpolation quantile of the non-NULL values of every group."""
    ranked = value_positions(df.where(F.col(value).isNotNull()), keys, value)
    position = F.lit(q) * (F.col("rows_total") - 1)
    low, high = F.floor(position), F.ceil(position)

    def holds(at: Column) -> Column:
        inside = (F.col("rows_below") <= at) & (at < F.col("rows_below") + F.col("rows_equal"))
        return F.when(inside, dbl(value))

    picked = ranked.groupBy(*keys).agg(
        F.max(holds(low)).alias("_low"),
        F.max(holds(high)).alias("_high"),
        F.max(position - low).alias("_part"),
    )
    at = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return picked.select(*keys, at.alias(out))
