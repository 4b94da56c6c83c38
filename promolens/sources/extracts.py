"""Delimited point-of-sale extracts: reading, checking, routing and profiling."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import mean_of

SEPARATOR = "|"
BAD_SHARE = 0.05
# File-name patterns (digits as X) and the table each one feeds; empty means skip.
FILE_TABLES = {
    "XXXXXXXX_CABECERAS_SEMXX_XXXX": "6_E_CABECERAS",
    "XXXXXXXX_LINEAS_SEMXX_XXXX": "7_ESTRUCTURA_LINEAS",
    "XXXXXXXX_M_LOCALIZACIONES_NEA_TABLA_XXXXXXXX": "8_ESTRUCTURA_LOC_NEA_TABLA_PVP",
    "XXXXXXXX_M_ARTICULOS_XXXXXXXX": "11_M_ARTICULOS",
    "XXXXXXXX_M_CLIENTES_TARJETAS": "12_M_CLIENTES_TARJETAS",
    "XXXXXXXX_M_COMPETITIVIDAD_XXXXXXXX": "13_M_COMPETITIVIDAD",
    "XXXXXXXX_M_ID_CLIENTE_TRAVEL_XXXXXXXX": "14_M_ID_CLIENTE_TRAVEL",
    "XXXXXXXX_M_LOCALIZACIONES_XXXXXXXX": "16_LOCALIZATIONES",
    "XXXXXXXX_M_OFER_PROMO": "17_M_OFER_PROMO_",
    "XXXXXXXX_M_OFERTAS_ART_LOC_SEMXX_XXXX": "18_OFERTAS_ART_LOC",
    "XXXXXXXX_H_REDEN_TEOR_DIA_SEMXX_XXXX": "20_H_REDEN_TEOR_DIA",
    "XXXXXXXX_H_RESUL_PROMO_SEMXX_XXXX": "21_RESUL_PROMO",
    "XXXXXXXX_M_ARTICULOS_SENALIZACION_XXXXXXXX": "",
    "XXXXXXXX_M_ARTICULOS_PROVEEDOR_XXXXXXXX": "",
    "XXXXXXXX_H_MARGEN_BRUTO_MES": "",
    "XXXXXXXX_H_APORT_EXTRA_SEMXX_XXXX": "10_M_APORT_EXTRA",
}
_BAD = "_bad_record"


def _strings(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(_BAD, T.StringType())])


def _reader(spark: SparkSession, schema: T.StructType, stream: bool = False):
    source = spark.readStream if stream else spark.read
    return (
        source.schema(_strings(schema))
        .option("sep", SEPARATOR)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .format("csv")
    )


def is_header(schema: T.StructType) -> Column:
    """A row that repeats the column names, whatever their case."""
    return reduce(and_, [F.lower(F.trim(F.col(f.name))).eqNullSafe(F.lit(f.name.lower())) for f in schema.fields])


def is_bad(schema: T.StructType) -> Column:
    """Too many fields or a value of the wrong type; missing last fields are fine."""
    too_long = F.coalesce(F.size(F.split(_BAD, r"\|")) > len(schema.fields), F.lit(False))
    wrong = [
        F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return reduce(or_, wrong, too_long)


def raw_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Extract rows as text without header rows, with file name and a bad mark."""
    rows = _reader(spark, schema).load(path)
    return mark_rows(rows, schema)


def mark_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    named = rows.select(*[f.name for f in schema.fields], _BAD, F.col("_metadata.file_name").alias("file_name"))
    return named.where(~is_header(schema)).withColumn("is_bad", is_bad(schema)).drop(_BAD)


def typed(rows: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    good = rows.where(~F.col("is_bad"))
    return good.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *keep)


def read_extract(spark: SparkSession, path: str | list[str], schema: T.StructType, bad_share: float = BAD_SHARE) -> DataFrame:
    """Typed rows of one extract; reading fails if too large a share of rows is bad.

    The share is a scalar subquery of the same plan, so nothing runs before the
    caller's own action.
    """
    rows = raw_rows(spark, path, schema)
    excess = rows.agg((F.count_if("is_bad") > F.floor(F.count(F.lit(1)) * bad_share)).alias("x")).scalar()
    stop = F.raise_error(F.lit("too many bad rows in the extract")).cast("boolean")
    return typed(rows.where(F.when(excess, stop).otherwise(F.lit(True))), schema)


def audit(rows: DataFrame) -> DataFrame:
    """Rows read, loaded and rejected per file."""
    return rows.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~F.col("is_bad")).alias("loaded_rows"),
        F.count_if("is_bad").alias("rejected_rows"),
    )


def table_of(file_name: Column, mapping: dict[str, str] = FILE_TABLES) -> Column:
    """Target table of a file, NULL for files to skip."""
    stem = F.regexp_replace(F.split(file_name, r"\.")[0], r"\d", "X")
    known = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    target = F.try_element_at(known, stem)
    return F.when(target != "", target)


def batch_of(file_name: Column) -> Column:
    """First run of digits in the file name."""
    return F.regexp_extract(file_name, r"(\d+)", 1).try_cast("long")


def stamp(rows: DataFrame) -> DataFrame:
    return rows.withColumn("TIMESTAMP", batch_of(F.col("file_name")))


def drop_short_lines(lines: DataFrame, columns: int) -> DataFrame:
    """Text lines with at least ``columns`` fields."""
    return lines.where(F.size(F.split("value", r"\|")) >= columns)


def fit_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename by position, add missing last columns as NULL and drop duplicate rows."""
    have = [F.col(c).alias(n) for c, n in zip(df.columns, names)]
    missing = [F.lit(None).cast("string").alias(n) for n in names[len(df.columns):]]
    return df.select(*have, *missing).dropDuplicates()


def column_profile(df: DataFrame) -> DataFrame:
    """Distinct, missing and numeric figures of every column, one row each."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    cells = as_text.unpivot([], df.columns, "column_name", "value")
    number = F.col("value").try_cast("decimal(18,6)")
    return cells.groupBy("column_name").agg(
        F.count_distinct("value").alias("distinct_values"),
        F.count_if(F.col("value").isNull()).alias("no_nulls"),
        F.count_if(F.col("value").isNotNull()).alias("no_non_nulls"),
        (F.floor(mean_of(number) * 10 + 0.5) / 10).alias("avg_value"),
        F.max(number).alias("max_value"),
        F.min(number).alias("min_value"),
    )


def read_model_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("encoding", "ISO-8859-1").csv(path)


def write_model_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
