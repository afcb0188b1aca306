"""Session settings the operators are planned for, and the shared scratch folder."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Every one of them is a Spark size check or a skew rule:
#  - lookups are broadcast only while Spark's size stays under the threshold, and fall back to a
#    shuffled join above it; before a table is read its size is that of its Parquet files, in which a
#    row may take a byte, so it counts as sixteen times that, and once shuffled as it was measured.
#    The driver builds a lookup in some four times its rows' bytes, and of a plan several at once;
#  - a join partition that holds a hot key is split at run time, also where the next
#    aggregation could have reused the join's partitioning;
#  - small shuffles still use every core, which matters to writes of many small days;
#  - the folders of a table are listed by some hundred tasks, not by one task per folder.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.sources.fileCompressionFactor": "16",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 10),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}

SHUFFLE_PARTITION_BYTES = 128 << 20


def tune(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Apply the library's runtime SQL settings to a session the caller already has.

    ``shuffled_bytes``, the most that one step is expected to shuffle, sizes the partitions: near
    128 MB each. That is what is left after filters and partial sums, not the size of the input.
    Spark merges partitions at run time but, hot join keys and rebalanced writes apart, never
    makes more of them.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffled_bytes is not None:
        partitions = max(200, math.ceil(shuffled_bytes / SHUFFLE_PARTITION_BYTES))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return spark


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller supplies one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daybook")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@functools.lru_cache(maxsize=None)
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="daybook-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder all executors share (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_scratch(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: columnar, sized, and safe to lose executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system it is on; nothing happens if it is not there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


class Scratch:
    """Stored tables of one run, removed when the run has written its results."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(shared_dir(self.spark, purpose))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Scratch]:
    scratch = Scratch(spark)
    try:
        yield scratch
    finally:
        for path in scratch.paths:
            remove(spark, path)
