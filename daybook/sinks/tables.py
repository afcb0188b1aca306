"""Result writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import CSV_OPTIONS
from daybook.session import Scratch, remove

MONTH = "month"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line, replacing what was there.

    ``single_file`` is for results bounded by the calendar (summary, forecast); facts keep their
    partitions.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_batches(
    df: DataFrame, path: str, fmt: str = "parquet", order: Sequence[str] = (), gather: bool = True
) -> None:
    """Replace exactly the days present in ``df`` in a table partitioned by ``batch_date``.

    ``gather`` rebalances the rows first, so that each day ends in files of the advisory size:
    small days share a task and a day that holds much of the data is split over many. Rows that
    already arrive by day, straight from a table stored by day, can do without that shuffle.
    Every file is sorted by ``order``; a day spread over several files is not sorted as a whole.
    """
    rows = df.hint("rebalance", "batch_date") if gather else df
    (
        rows.sortWithinPartitions("batch_date", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV_OPTIONS)
        .partitionBy("batch_date")
        .format(fmt)
        .save(path)
    )


def stored_parts(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """The values that a table partitioned by ``column`` has folders for, and the folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    marked = [name for name in names if name.startswith(f"{column}=")]
    return {name.partition("=")[2]: f"{path.rstrip('/')}/{name}" for name in marked}


def _replace(df: DataFrame, path: str, column: str, inside, write) -> None:
    """Write ``df`` and remove the folders inside the range whose values it does not have."""
    spark = df.sparkSession
    before = stored_parts(spark, path, column)
    new = {str(row[0]) for row in df.select(column).distinct().collect()}  # the calendar bounds them
    if new or not before:
        write()
    for value, folder in before.items():
        if inside(value) and value not in new:
            remove(spark, folder)


def replace_days(
    df: DataFrame,
    path: str,
    first: dt.date,
    last: dt.date,
    fmt: str = "parquet",
    order: Sequence[str] = (),
) -> None:
    """Replace all days from ``first`` to ``last``: those in ``df`` are written, the others emptied."""
    inside = lambda day: first.isoformat() <= day <= last.isoformat()
    _replace(df, path, "batch_date", inside, lambda: write_batches(df, path, fmt, order))


def replace_days_in_months(df: DataFrame, path: str, first: dt.date, last: dt.date, scratch: Scratch) -> None:
    """The same for a table of few rows a day, stored as Parquet by month.

    The other days of the first and the last month are read and written again.
    """
    spark, month = df.sparkSession, F.date_format("batch_date", "yyyy-MM").alias(MONTH)
    rows = df.select("*", month)
    if stored_parts(spark, path, MONTH):
        bounds = F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date")
        kept = spark.read.schema(df.schema).parquet(path).select(*df.columns, month).filter(
            F.col(MONTH).isin(f"{first:%Y-%m}", f"{last:%Y-%m}") & ~F.col("batch_date").between(*bounds)
        )
        rows = rows.unionByName(kept)
    rows = scratch.store(rows, "months")

    def write() -> None:
        rows.hint("rebalance", MONTH).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(MONTH).parquet(path)

    inside = lambda value: f"{first:%Y-%m}" <= value <= f"{last:%Y-%m}"
    _replace(rows, path, MONTH, inside, write)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by :func:`replace_days_in_months`."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
