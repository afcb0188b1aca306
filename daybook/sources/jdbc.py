"""JDBC tables: partitioned reads and batched writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def connection_options(
    url: str, table: str, user: str, password: str, driver: str | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if driver:
        options["driver"] = driver
    return options


def split_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Read in ``partitions`` parallel ranges of a numeric or date column.

    The bounds only set the stride; rows outside them still arrive with the first or last range.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession,
    connection: dict[str, str],
    split: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Filters and column choices on the result are pushed down into the database."""
    return (
        spark.read.format("jdbc")
        .options(**connection, **(split or {}), fetchsize=str(fetch_size))
        .load()
    )


def write_table(
    df: DataFrame, connection: dict[str, str], connections: int = 8, batch_size: int = 10_000
) -> None:
    """Replace the rows of a table, keeping its definition, over a bounded number of connections."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**connection, truncate="true", batchsize=str(batch_size), numPartitions=str(connections))
        .save()
    )
