"""Session settings and the shared folder in which reused tables are kept."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; everything else is left to the cluster.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", name: str = "promolens") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("PROMOLENS_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
    )
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def hash_joins(spark: SparkSession, limit: str = "64MB") -> Iterator[None]:
    """Inside, a join whose parts all turn out smaller than ``limit`` may build hash maps of them and sort no side.

    Spark decides by the sizes it has seen, and only where ``limit`` is at least its advisory partition size. A limit
    that the session has set stays.
    """
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    if before not in ("0", "0b"):
        yield
        return
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def joins_in_place(spark: SparkSession) -> Iterator[None]:
    """Inside, a join finds its rows placed where they are placed by some of its keys, and Spark shuffles them no more.

    For tables whose rows come placed by a key that is fine enough, such as the product: one that is not would leave
    much of the join to few tasks.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: executors of
    a cluster could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="promolens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Workspace:
    """Writes a DataFrame once and hands back the table read from storage.

    Lineage ends at the written table, so a lost executor costs a re-read and not
    a rebuild, and a plan that uses a fact five times holds five scans instead of
    five copies of the fact's own plan.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/promolens-{uuid.uuid4().hex}"
        self._uses: dict[str, int] = {}

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None, placed_by: list[str] | None = None) -> DataFrame:
        """The table as written; a name used again gets a folder of its own, as the first table may still be read.

        ``placed_by`` names columns by which the rows are already placed in as many parts as a shuffle has. The table
        is then written in a bucket for each part, so that readers find the rows placed and need not shuffle them.
        """
        self._uses[name] = n = self._uses.get(name, 0) + 1
        path = f"{self.folder}/{name}" if n == 1 else f"{self.folder}/{name}-{n}"
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if placed_by:
            table = f"{self.folder.rsplit('/', 1)[-1]}_{name}_{n}".replace("-", "_")
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer.bucketBy(buckets, *placed_by).option("path", path).format("parquet").saveAsTable(table)
            return self.spark.table(table)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
