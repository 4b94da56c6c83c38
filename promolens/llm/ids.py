"""Ids on their way through pandas, where a long column with a null turns to floating point and loses what lies above 2^53."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text(df: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("string"))


def as_long(df: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))
