"""Rows equal in doc_id and text, looked at once and laid out again."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.words import raw_bytes

LAID_AT_ONCE = 4096  # equal rows that one task writes

_MERGED = "part int, doc_id bigint, packed binary, copies bigint"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, so that many of them do not travel to one part; texts compressed."""
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        seen = Counter(zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))))
        part, doc_id, text = zip(*seen) if seen else ((), (), ())
        yield pa.record_batch(
            [pa.array(part, pa.int32()), pa.array(doc_id, pa.int64()),
             pa.array(map(compress, map(raw_bytes, text)), pa.binary()), pa.array(seen.values(), pa.int64())],
            ["part", "doc_id", "packed", "copies"],
        )


def merged_parts(docs: DataFrame, parts: int) -> DataFrame:
    """part, doc_id, packed (the text, null as empty), copies: the different rows, dealt to ``parts``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")
    merged = rows.select(part.alias("part"), "doc_id", "text").mapInArrow(_merge, _MERGED)
    return merged.repartition("part").groupBy("part", "doc_id", "packed").agg(F.sum("copies").alias("copies"))


def raw_texts(table: pa.Table) -> list[bytes]:
    decompress = zstandard.ZstdDecompressor().decompress
    return [decompress(text) for text in table.column("packed").to_pylist()]


def laid_out(stored: DataFrame, at_once: int = LAID_AT_ONCE) -> DataFrame:
    """Every row of a stored table as often as its copies say; many copies are laid out by many tasks."""
    few = stored.filter(F.col("copies") <= at_once)
    few = few.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("k"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / at_once))
    many = stored.filter(F.col("copies") > at_once).select("*", F.explode(blocks).alias("block"))
    held = F.least(F.lit(at_once), F.col("copies") - F.col("block") * at_once)
    many = many.repartition("doc_id", "block").select("*", F.explode(F.sequence(F.lit(1).cast("long"), held)).alias("k"))
    return few.drop("k", "copies").unionByName(many.drop("k", "copies", "block"))
