"""Nested order documents, addressed by business day.

All days live in one dataset partitioned by ``batch_date``; a date range is a partition filter,
so a run over many days is one scan and not one read per day. Files and collections that carry the
day in their name are read as such a dataset too.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.dates import DAY_CODE, parse_order_time
from daybook.schemas import CSV_OPTIONS, TRANSACTIONS

UNREADABLE = "unreadable"


def _dated(schema: T.StructType) -> T.StructType:
    if "batch_date" in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField("batch_date", T.DateType())])


def _day_in_name() -> Column:
    """The day that eight digits of the file name give, as in transactions_20240201.json."""
    digits = F.regexp_extract(F.col("_metadata.file_name"), r"(?<!\d)(\d{8})(?!\d)", 1)
    return F.to_date(F.try_to_timestamp(digits, F.lit(DAY_CODE)))


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTIONS,
    multi_line: bool = False,
    day_in_name: bool = False,
    keep_unreadable: bool = False,
) -> DataFrame:
    """JSON documents under ``path`` (one per line; ``multi_line`` for one array per file).

    ``batch_date`` is the document's own or its folder's, else with ``day_in_name`` the day in the
    name of its file, else null, and then the day of the order counts. A document that cannot be read
    fails the job, or with ``keep_unreadable`` is a row of nulls with its text in ``unreadable``.
    """
    dated = _dated(schema)
    reader = spark.read.option("multiLine", multi_line)
    if keep_unreadable:
        dated = T.StructType([*dated.fields, T.StructField(UNREADABLE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", UNREADABLE)
    else:
        reader = reader.option("mode", "FAILFAST")
    documents = reader.schema(dated).json(path)
    if not day_in_name:  # keeps a folder's day as it is, a filter of which skips files
        return documents
    return documents.withColumn("batch_date", F.coalesce("batch_date", _day_in_name()))


def readable(documents: DataFrame) -> DataFrame:
    """The documents that could be read, without the text of the others."""
    return documents.filter(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def unreadable(documents: DataFrame) -> DataFrame:
    """The text of the documents that could not be read."""
    return documents.filter(F.col(UNREADABLE).isNotNull()).select(UNREADABLE)


def read_collection(
    spark: SparkSession,
    connector: str,
    options: dict[str, str],
    schema: T.StructType = TRANSACTIONS,
    day: str | dt.date | None = None,
) -> DataFrame:
    """A document-store collection through whichever Spark connector is on the class path.

    ``day`` becomes the ``batch_date`` of documents that carry none.
    """
    found = spark.read.format(connector).options(**options).schema(_dated(schema)).load()
    return found if day is None else found.withColumn("batch_date", F.coalesce("batch_date", _date(day)))


def read_daily_collections(
    spark: SparkSession,
    connector: str,
    options: dict[str, str],
    name_option: str,
    prefix: str,
    first: str | dt.date,
    last: str | dt.date,
    schema: T.StructType = TRANSACTIONS,
) -> DataFrame:
    """Collections named ``prefix`` and a day, as in transactions_20240201, for a range of days.

    ``name_option`` is the connector's option for the name of a collection. The union has one branch
    a day, so a long history is better stored once with :func:`daybook.sinks.tables.write_batches`.
    """
    start, end = _as_date(first), _as_date(last)
    days = [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]
    if not days:
        raise ValueError("the range holds no day")
    parts = [
        read_collection(spark, connector, {**options, name_option: f"{prefix}{day:%Y%m%d}"}, schema, day)
        for day in days
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A table written by :func:`daybook.sinks.tables.write_batches`; text of CSV may hold line breaks."""
    reader = spark.read.schema(_dated(schema)).options(**CSV_OPTIONS)
    return reader.option("multiLine", True).format(fmt).load(path)


def on_days(batches: DataFrame, days: DataFrame) -> DataFrame:
    """Batches of the days that a table of days (``batch_date``) names.

    The days are found first and only their folders are read. Spark does so for days that a comparison
    chooses, so there is one here that all days pass, and while their table is below the broadcast limit,
    as a calendar always is.
    """
    chosen = days.select("batch_date").filter(F.col("batch_date") >= _date(dt.date.min))
    return batches.join(chosen, "batch_date", "left_semi")


def _as_date(day: str | dt.date) -> dt.date:
    return dt.datetime.strptime(day, "%Y%m%d").date() if isinstance(day, str) else day


def day_bounds(first: str | dt.date, last: str | dt.date) -> tuple[dt.date, dt.date]:
    return _as_date(first), _as_date(last)


def _date(day: str | dt.date) -> Column:
    return F.lit(_as_date(day).isoformat()).cast("date")


def between_days(batches: DataFrame, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """Batches of an inclusive range of days, given as dates or as yyyyMMdd text.

    Documents without ``batch_date`` belong to the day of their order; rows with neither to none.
    """
    first, last = _date(first), _date(last)
    if "timestamp" not in batches.columns:
        return batches.filter(F.col("batch_date").between(first, last))
    ordered = F.to_date(parse_order_time(F.col("timestamp"))).between(first, last)
    if "batch_date" not in batches.columns:
        return batches.filter(ordered)
    return batches.filter(F.col("batch_date").between(first, last) | (F.col("batch_date").isNull() & ordered))
