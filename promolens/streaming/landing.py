"""Incremental landing: files not seen before are checked, stamped, profiled and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.extracts import _reader, audit, column_profile, mark_rows, stamp, typed


def land(
    spark: SparkSession, source: str, target: str, state: str, schema: T.StructType,
    files_per_batch: int = 200, bad_share: float = 0.05, quarantine: str | None = None,
) -> None:
    """Load all new files of ``source`` and stop.

    A file with more than ``bad_share`` bad rows fails its batch before anything is written, and the files stay
    to be loaded. With a ``quarantine`` folder its rows go there as they were read, the audit counts none of
    them as loaded, and the other files are loaded.

    The stream's own record of files replaces 'already loaded' checks. A batch
    writes into a folder of its own number, so a retried batch replaces its rows
    instead of adding them twice.
    """
    rows = _reader(spark, schema, stream=True).option("maxFilesPerTrigger", files_per_batch).load(source)
    marked = mark_rows(rows, schema)

    def write(batch: DataFrame, number: int) -> None:
        checked = batch.persist()
        counts = audit(checked).withColumn(
            "accepted", F.col("rejected_rows") <= F.floor(F.col("source_rows") * bad_share)
        )
        refused = [r.file_name for r in counts.where("NOT accepted").select("file_name").limit(20).collect()]
        if refused and quarantine is None:
            checked.unpersist()
            raise ValueError(f"too many bad rows in {', '.join(refused)}")
        if refused:
            counts = counts.withColumn("loaded_rows", F.when(F.col("accepted"), F.col("loaded_rows")).otherwise(0))
            bad = checked.join(counts.where("NOT accepted").select("file_name"), "file_name", "left_semi")
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        good = checked.join(counts.where("accepted").select("file_name"), "file_name", "left_semi")
        stamped = stamp(typed(good, schema, "file_name"))
        stamped.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        counts.write.mode("overwrite").parquet(f"{target}/audit/batch={number}")
        column_profile(stamped.drop("file_name")).write.mode("overwrite").parquet(f"{target}/profile/batch={number}")
        checked.unpersist()

    query = (
        marked.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, target: str, what: str = "rows") -> DataFrame:
    return spark.read.parquet(f"{target}/{what}")
