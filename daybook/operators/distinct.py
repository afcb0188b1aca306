"""Exact distinct counts that add up: a day's orders as bitmaps, any range of days without its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_bitmaps(lines: DataFrame, day: str = "batch_date", key: str = "order_id") -> DataFrame:
    """day, bucket, bits: which whole-number keys each day has, 32,768 of them to a bitmap of 4 KB.

    Bitmaps are built in each task first, so a day or an order with very many lines travels as its bits.
    Lines without day or key are left out. Made for keys that are dealt in sequence, as order ids are;
    keys spread over all numbers take a bitmap each.
    """
    known = lines.filter(F.col(day).isNotNull() & F.col(key).isNotNull())
    of_key = known.select(F.col(day).alias("day"), F.col(key).cast("bigint").alias("key"))
    return of_key.groupBy("day", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")
    )


def distinct_in_ranges(bitmaps: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (first_day, last_day and any others) with ``num_keys``, the distinct keys of all days from
    one to the other. Ranges may overlap. They are opened into days, which the calendar bounds, and met by
    equality; bitmaps of the same bucket are united, which counts a key of several days once."""
    named = ranges.withColumn("range_key", F.xxhash64(*ranges.columns))
    days = named.filter("first_day <= last_day").select(
        "range_key", F.explode(F.sequence("first_day", "last_day")).alias("day")
    ).distinct()
    united = bitmaps.join(days, "day").groupBy("range_key", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = united.groupBy("range_key").agg(F.sum(F.bitmap_count("bits")).alias("num_keys"))
    none = F.lit(0).cast("bigint")
    return named.join(counts, "range_key", "left").select(*ranges.columns, F.coalesce("num_keys", none).alias("num_keys"))
