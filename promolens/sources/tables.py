"""Tables on shared storage: partitioned, clustered, replaced as a whole or by slice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
    slices_only: bool = False,
) -> None:
    """Replace a table, or with ``slices_only`` just the partitions that ``df`` holds.

    Rows of a partition value come together in tasks of the advisory size: a small value makes one file, a hot
    one is split over as many tasks as it needs. Cluster columns order the rows inside the files.
    """
    placed = [*(partition_by or []), *(cluster_by or [])]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if placed:
        df = df.sortWithinPartitions(*placed)
    writer = df.write.mode("overwrite")
    if slices_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


MONTH = "month_key"


def _month_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_clustered(df: DataFrame, table: str, path: str, buckets: int, keys: list[str], day: str = "date") -> DataFrame:
    """A daily fact as a table partitioned by month and bucketed by ``keys``; returns the table.

    Joins and groups on the keys, or on more columns than the keys, then need no exchange. Rows meet their bucket
    before they are written, so a bucket has one file a month and not one for every task. ``buckets`` should give
    files of some hundred megabytes; the keys must be fine enough that no single one of them outgrows a task.
    """
    rows = df.withColumn(MONTH, _month_of(day)).repartition(buckets, *keys)
    writer = rows.write.mode("overwrite").option("path", path).partitionBy(MONTH)
    writer.bucketBy(buckets, *keys).sortBy(*keys, day).saveAsTable(table)
    return df.sparkSession.table(table)


def between_days(table: DataFrame, first: dt.date, last: dt.date, day: str = "date") -> DataFrame:
    """Rows of a clustered table between two days; only the months between them are listed and read."""
    months = F.col(MONTH).between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    return table.where(months & F.col(day).between(F.lit(first), F.lit(last))).drop(MONTH)


def republish(spark: SparkSession, source: str, target: str, casts: dict[str, str]) -> None:
    """Rewrite a table with other types under a new path; Spark cannot replace what it reads."""
    df = spark.read.parquet(source)
    df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()}).write.mode("overwrite").parquet(target)
