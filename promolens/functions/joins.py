"""Join helpers for keys that are often missing and for full products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col


def spread_missing(key: Column | str, *by: Column | str) -> Column:
    """String join key in which missing values are spread over many partitions.

    The stand-in never equals a real key, so an outer join keeps such rows
    unmatched, as it would for NULL.
    """
    stand_in = F.concat(F.lit("\u0001none"), F.pmod(F.xxhash64(*[col(c) for c in by]), F.lit(1024)))
    return F.coalesce(col(key).cast("string"), stand_in)


def all_pairs(left: DataFrame, right: DataFrame, left_cells: int = 64, right_cells: int = 4) -> DataFrame:
    """Every left row with every right row, as an equi-join on a grid of cells.

    Each left row falls in one of ``left_cells`` cells and is copied to all
    ``right_cells``; the right side the other way round. Work spreads over the
    whole grid and neither side has to fit in one task.
    """
    lcell = F.pmod(F.xxhash64(*left.columns), F.lit(left_cells)).cast("int")
    rcell = F.pmod(F.xxhash64(*right.columns), F.lit(right_cells)).cast("int")
    lhs = left.withColumn("_l", lcell).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(right_cells - 1))))
    rhs = right.withColumn("_r", rcell).withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(left_cells - 1))))
    return lhs.join(rhs, ["_l", "_r"]).drop("_l", "_r")
