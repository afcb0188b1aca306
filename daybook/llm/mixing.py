"""Mixes sources to target weights.

Words are summed per source, the sums give each source's target and from it a repetition rate, and a
document is taken floor(rate) times plus once more with a probability of the fraction, drawn from a
hash of the document. The coin needs no state, so reruns and lost executors give the same copies.
Equal rows are numbered and share one coin: of n of them, n times the fraction are taken once more,
rounded by the coin, since one coin tossed for each would be the same n times.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import ROW, WORD, packed, unpacked
from daybook.operators.running import running_total
from daybook.session import materialise

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
SEED = 1
COIN_DIGITS = 13  # hex digits of the coin, 52 bits
KEY = ["from_source", "id", "text_key"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES
) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    Sources are ordered by code point, the missing source last, and weigh ``weights`` in turn. Their
    targets share the size of all documents by weight; no target exceeds ``most_times`` the size of
    its source, and what is above is shared among the others by weight until none is above. That is
    the level at which min(most_times * size, level * weight) sums to the whole: sources are taken by
    the level that fills them, and one is full if the level reached with all before it full exceeds
    its own. All sums are exact; they run over sources in blocks, and one task adds one row a block.
    """
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = running_total(
        sources.select("*", F.col("source").isNull().alias("last"), F.lit(1).alias("one")),
        [], ["last", "source"], "one", "position",
    )
    nth = (F.col("position") - 1) % len(weights) + 1
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), nth.cast("int"))
    weighed = numbered.select(
        "source", "position", "source_size", weight.cast("long").alias("weight"),
        (F.col("source_size") * most_times).alias("most"),
    ).withColumn("fills_at", F.col("most").cast("double") / F.col("weight"))
    filling = running_total(weighed, [], ["fills_at", "position"], "most", "filled")
    filling = materialise(
        running_total(filling, [], ["fills_at", "position"], "weight", "weighed"), "sources"
    )
    size, weight = filling.agg(F.sum("source_size"), F.sum("weight")).first()
    size, weight = size or 0, weight or 0
    left = F.lit(size) - (F.col("filled") - F.col("most"))
    full = left * F.col("weight") > F.col("most") * (F.lit(weight) - F.col("weighed") + F.col("weight"))
    full_size, full_weight = filling.filter(full).agg(F.sum("most"), F.sum("weight")).first()
    rest_size, rest_weight = size - (full_size or 0), weight - (full_weight or 0)
    level = F.lit(float(rest_size)) / F.lit(float(max(rest_weight, 1)))
    target = F.when(full, F.col("most").cast("double")).otherwise(level * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return materialise(
        filling.select("source", "source_size", target.alias("target")).withColumn("rate", rate), "rates"
    )


def coin(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 up to 1, the same in every run: by the md5 of seed, doc_id and text."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("-")), text)
    digits = F.substring(F.md5(key), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**COIN_DIGITS))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``, from 1 among rows of equal source, doc_id and text.

    One row per document is counted by a hash of its text. Only rows that are repeated are laid out, in
    blocks, so a row that makes up a third of the table is numbered by many tasks.
    """
    counted = rows.groupBy(*KEY).agg(F.count("*").alias("times")).filter("times > 1")
    repeated = materialise(counted.select(*(F.col(name).alias(f"of_{name}") for name in KEY)), "repeated")
    same = functools.reduce(Column.__and__, (F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in KEY))
    if repeated.isEmpty():
        return rows.withColumn("nth", F.lit(1).cast("long"))
    once = rows.join(repeated, same, "left_anti").withColumn("nth", F.lit(1).cast("long"))
    # rows that differ elsewhere are told apart by what they hold, so that reruns choose the same ones
    laid = rows.join(repeated, same, "left_semi").select(
        "*", F.xxhash64(F.to_json(ROW)).alias("held"), F.monotonically_increasing_id().alias("place"),
        F.lit(1).cast("long").alias("one"),
    )
    many = running_total(laid, KEY, ["held", "place"], "one", "nth").drop("held", "place", "one")
    return once.unionByName(many)


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_times: int = MOST_TIMES,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and copies, how often the mix takes it.

    A null text has size 0; a null source is a source of its own. Documents without words are copied
    at the rate of their source, and not at all if the whole source has no words. Rows of equal source,
    doc_id and text are taken floor(rate) or floor(rate) + 1 times, the latter as often as the fraction
    asks; a row that is not repeated depends on its own coin only. Very long texts are read whole and
    travel only if their row is repeated. An empty table gives an empty table. Columns of ``docs`` with
    these names are replaced.
    """
    rates = source_rates(docs, weights, most_times)
    rows = packed(
        docs, from_source=docs["source"], id=docs["doc_id"], text_key=F.xxhash64(docs["text"]),
        size=word_count(docs["text"]), coin=coin(docs["doc_id"], docs["text"], seed),
    )
    joined = _numbered(rows).join(rates, F.col("from_source").eqNullSafe(F.col("source")))
    whole = F.floor("rate")
    fraction = F.col("rate") - whole
    # of the first n equal rows, so many are taken once more; for a row on its own: coin < fraction
    more = lambda n: F.ceil(n * fraction - F.col("coin"))
    copies = whole + more(F.col("nth")) - more(F.col("nth") - 1)
    return unpacked(
        joined, docs, size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"), copies=copies
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every row as often as :func:`plan_mix` says, and no other columns."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")
    planned = plan_mix(rows, **how)
    return planned.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
