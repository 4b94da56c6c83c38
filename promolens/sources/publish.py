"""Tables that readers see whole or not at all: versioned data folders and a manifest.

Every publication writes its rows to a folder of its own and then appends one small file to the manifest. A version
is the list of slices and folders that its manifest file names; what no manifest file names is never read. A job that
ends between the two writes therefore leaves the last version as it was, and a reader that has resolved a version
keeps reading the same files while the next one is written.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version long, token string, slice string, folder string, columns string"
_WHOLE = "all"


def _slice_name(column: str | None) -> Column:
    """Folder name of a slice; missing and empty values keep names of their own."""
    if column is None:
        return F.lit(_WHOLE)
    return F.coalesce(F.concat(F.lit("v"), F.col(column).cast("string")), F.lit("n"))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """All publications; an unpublished table has none."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per complete version with its columns as text."""
    return _manifest(spark, root).where("slice is null").select("version", "token", "columns")


def _resolve(spark: SparkSession, root: str, version: int | None = None):
    """The newest version, or the one asked for; of two written at the same time the greater token counts."""
    rows = versions(spark, root)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    return rows.orderBy(F.desc("version"), F.desc("token")).first()


def write_rows(df: DataFrame, root: str, slice_by: str | None = None) -> str:
    """First half of a publication: the rows in a folder that no reader knows yet."""
    folder = f"f{uuid.uuid4().hex}"
    rows = df.withColumn("_slice", _slice_name(slice_by))
    if slice_by is not None:
        rows = rows.hint("rebalance", "_slice")
    rows.write.partitionBy("_slice").parquet(f"{root}/data/_folder={folder}")
    return folder


def publish(df: DataFrame, root: str, slice_by: str | None = None, keep_others: bool = False, base: int | None = None) -> int:
    """Make ``df`` the next version and return its number.

    With ``slice_by`` and ``keep_others`` only the slices that ``df`` holds are replaced; the others stay as files of
    earlier versions and are not written again. The columns must then be the ones published before. The others are
    those of the newest version, or of version ``base``.
    """
    if {"_slice", "_folder"} & set(df.columns):
        raise ValueError("_slice and _folder are names of the published table")
    spark = df.sparkSession
    last = _resolve(spark, root)
    kept = last if base is None else _resolve(spark, root, base)
    columns = df.schema.json()
    if keep_others and kept is not None and [(f.name, f.dataType) for f in StructType.fromJson(json.loads(kept.columns))] != [
        (f.name, f.dataType) for f in df.schema
    ]:
        raise ValueError("slices of one version need the same columns")
    folder = write_rows(df, root, slice_by)
    number, token = (0 if last is None else last.version) + 1, uuid.uuid4().hex
    written = _written(spark, root, folder, df.schema).select("_slice").distinct()
    mine = written.select(F.col("_slice").alias("slice"), F.lit(folder).alias("folder"))
    if keep_others and kept is not None:
        others = _named(spark, root, kept).join(mine.select("slice"), "slice", "left_anti")
        mine = mine.unionByName(others)
    head = spark.range(1).select(F.lit(None).cast("string").alias("slice"), F.lit(None).cast("string").alias("folder"))
    entries = head.unionByName(mine).select(
        F.lit(number).cast("long").alias("version"), F.lit(token).alias("token"), "slice", "folder",
        F.when(F.col("slice").isNull(), F.lit(columns)).alias("columns"),
    )
    # One file, so that it is there as a whole or not at all.
    entries.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return number


def _written(spark: SparkSession, root: str, folder: str, schema: StructType) -> DataFrame:
    whole = StructType(list(schema.fields)).add("_slice", "string")
    return spark.read.schema(whole).parquet(f"{root}/data/_folder={folder}")


def _named(spark: SparkSession, root: str, entry) -> DataFrame:
    """Slices and folders of one version."""
    mine = (F.col("version") == entry.version) & (F.col("token") == entry.token) & F.col("slice").isNotNull()
    return _manifest(spark, root).where(mine).select("slice", "folder")


def read_published(spark: SparkSession, root: str, version: int | None = None, slices: list[str] | None = None) -> DataFrame:
    """The newest complete version, or an earlier one. Only folders that it names are scanned, and of these only the given slices."""
    entry = _resolve(spark, root, version)
    if entry is None:
        raise ValueError(f"no complete version under {root}")
    schema = StructType.fromJson(json.loads(entry.columns))
    named = _named(spark, root, entry)
    if slices is not None:
        named = named.where(F.col("slice").isin([f"v{s}" for s in slices]))
    # The folders of a version are as many as its publications still in use: a short list for partition pruning.
    folders = [r.folder for r in named.select("folder").distinct().collect()]
    whole = StructType(list(schema.fields)).add("_slice", "string").add("_folder", "string")
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(whole).parquet(f"{root}/data").where(F.col("_folder").isin(folders))
    if slices is not None:
        rows = rows.where(F.col("_slice").isin([f"v{s}" for s in slices]))
    kept = rows.join(named.select(F.col("slice").alias("_slice"), F.col("folder").alias("_folder")), ["_folder", "_slice"], "left_semi")
    return kept.select(*schema.fieldNames())
