"""Pairs of a Spark query and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle_mart import compose


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "d":
        c = c.cast("double")
    elif kind == "i":
        c = c.cast("long")
    elif kind == "s":
        c = c.cast("string")
    elif kind == "l":
        c = F.array_join(c, ",")
    elif kind == "r":
        c = F.round(c.cast("double"), 6)
    return c.alias(name)


def _sql_column(name: str, kind: str) -> str:
    forms = {
        "": "{0}", "d": "{0}::DOUBLE", "i": "{0}::BIGINT", "s": "{0}::VARCHAR",
        "l": "array_to_string({0}, ',')", "r": "round({0}::DOUBLE, 6)",
    }
    return forms[kind].format(name) + f" AS {name}"


def _parse(spec: str) -> list[tuple[str, str]]:
    return [(word.split(":") + [""])[:2] for word in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    """Result columns: ``name:d`` double, ``:i`` long, ``:s`` text, ``:l`` joined list, ``:r`` six decimals."""
    return df.select(*[_spark_column(n, k) for n, k in _parse(spec)])


def shaped_sql(sql: str, spec: str) -> str:
    source = sql if sql.isidentifier() else f"({sql})"
    return f"SELECT {', '.join(_sql_column(n, k) for n, k in _parse(spec))} FROM {source}"


def add(
    name: str, frame: Callable[[SparkSession, str], DataFrame], spec: str, sql: str | None = None,
    extra: dict[str, str] | None = None, recursive: set[str] = frozenset(),
) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    full = None if sql is None else compose(shaped_sql(sql, spec), extra, recursive)
    QUERIES[name] = Query(lambda spark, sf_dir: shaped(frame(spark, sf_dir), spec), full)
