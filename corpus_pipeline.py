"""Documents to training shards: quality, near-duplicates, benchmark passages, mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import compression_quality, decontaminate, mixing, sharding, simhash
from daybook.llm.queries import SHARDS
from daybook.llm.rows import table
from daybook.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score reaches the threshold; the model learns from the labelled rows of ``docs``.

    A null or empty text has a score too. Equal rows are kept or go together, whole texts are scored,
    however long, and all columns are returned as they are. An empty table stays empty.
    """
    model = compression_quality.train(docs, table(spark, sf_dir, "labels"))
    return compression_quality.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates.

    Null texts and texts without words have fingerprint zero and are one group. Of equal rows one
    stays. Whole texts are read, other columns are carried along, and an empty table stays empty.
    """
    return simhash.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, also of items without item_id.

    Rows with a null text or one without words stay, equal rows stay or go together, and whole texts are
    searched. Without items, or without words in them, all rows stay.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their source's weight asks.

    Null is a source of its own. Rows without words have size 0. Equal rows are
    counted together and share one coin. Texts are counted whole, and an empty table stays empty.
    """
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with the slot and shard they go to; equal rows go to one shard, and an empty table stays empty."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

#: Compressed sizes have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next.

    Nulls, empty and very long texts, equal rows and empty tables are handled as each stage states; extra
    columns of ``documents`` reach the end, where slot and shard replace columns of those names.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
