"""Tables stored by key, so that joins and sums on that key need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: About as much of the greater table as one task should read.
BUCKET_BYTES = 128 << 20


def buckets_for(stored_bytes: int) -> int:
    """How many buckets two tables need that are to be joined, by the bytes of the greater one."""
    return max(8, -(-stored_bytes // BUCKET_BYTES))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Stores ``df`` under ``path`` in as many buckets by ``key``, each sorted by it, and returns the table.

    Rows are dealt by key first, so a bucket is one file. Tables with the same key and number of buckets
    meet bucket by bucket. A key with very many rows makes its bucket large: where one may hold a third
    of all rows, leave the table as it is and let the join split it at run time.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A table that an earlier session stored with :func:`write_bucketed`, under a new name."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)
