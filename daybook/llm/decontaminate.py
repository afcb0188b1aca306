"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of words of a benchmark item, and the set of its shingles. A document that holds
the window holds all of them, so it is enough to look for one, and the rarest in the corpus is looked
for: the window's prefix in the order of rarity. A document's shingle that equals a prefix is a
candidate; it stands if the window, laid over that place, stays inside the document (length and
position), and if all words there are equal.

While the benchmark is small it is broadcast, and a document's words are at hand where a candidate is
found. Beyond that, places are shuffled as numbers only; the text of a document with candidates is
fetched once and the words at its candidates compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.rows import ascii_lower, packed, unpacked
from daybook.session import materialise

WINDOW = 10
SHINGLE = 3
# Fixed value: what separates words after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Broadcast are the benchmark's shingles while they and their windows take no more bytes than this, and
#: likewise the keys of documents to drop, of so many bytes each.
BROADCAST_BYTES, KEY_BYTES = 32 << 20, 64


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def shingle_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + k) for k in range(size)))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """window, n, item_id: every run of ``size`` words of an item, or all its words if there are fewer."""
    worded = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - n + 1)
    runs = worded.select("item_id", "words", n.alias("n"), F.explode(starts).alias("start"))
    return runs.select(F.slice("words", F.col("start"), F.col("n")).alias("window"), "n", "item_id").distinct()


def _shingles(runs: DataFrame) -> DataFrame:
    """The shingles of distinct windows: window_id, window, n, size, offset, key."""
    size = F.least("n", F.lit(SHINGLE))
    placed = runs.select("window_id", "window", "n", size.alias("size")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size"))).alias("offset")
    )
    key = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        key = F.when(F.col("size") == k, shingle_at(F.col("window"), F.col("offset"), k)).otherwise(key)
    return placed.withColumn("key", key)


def _places(docs: DataFrame, size: int, *columns: str) -> DataFrame:
    """Every place of a shingle of ``size`` words: words, columns, at, key."""
    worded = docs.select(*columns, words_of(F.col("text")).alias("words"))
    spread = worded.select("words", *columns, F.posexplode("words").alias("at", "word"))
    return spread.select("words", *columns, "at", shingle_at(F.col("words"), F.col("at"), size).alias("key"))


def _marked(rows: DataFrame, marks: DataFrame, how: str = "left") -> DataFrame:
    """Join on doc_id, null included, and text_key; the columns of the right one are added."""
    named = marks.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_text"})
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    return rows.join(named, same, how).drop("of_doc", "of_text")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def _union(parts: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    whole = spark.range(0).select(*(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in schema.split(", "))))
    for part in parts:
        whole = whole.unionByName(part)
    return whole


def _candidates(rows: DataFrame, prefixes: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, start, n, window_id: where a prefix of ``size`` words stands with room for its window.

    Only numbers are shuffled, some 40 bytes a place, however long the document is.
    """
    places = _places(rows, size, "doc_id", "text_key").select(
        "doc_id", "text_key", "at", "key", F.size("words").alias("n_words")
    )
    of_size = prefixes.filter(F.col("size") == size).select("key", F.explode("prefixed").alias("p"))
    wanted = of_size.select("key", "p.window_id", "p.offset", "p.n")
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    return places.join(wanted, "key").filter(inside).select("doc_id", "text_key", start.alias("start"), "n", "window_id")


def _verified(rows: DataFrame, met: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates whose words are those of their window.

    A text is fetched once with all its candidates. What is compared is at most a window long.
    """
    per_doc = met.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n", "window_id")).alias("met"))
    fetched = _marked(rows, per_doc, "inner").select("doc_id", "text_key", words_of(F.col("text")).alias("words"), "met")
    laid = fetched.select("doc_id", "text_key", "words", F.explode("met").alias("c")).select(
        "doc_id", "text_key", "c.*", F.slice("words", F.col("c.start") + 1, F.col("c.n")).alias("run")
    )
    alike = laid.filter(F.xxhash64("run", "n") == F.col("window_id"))  # few are left to be shuffled
    return alike.join(known, "window_id").filter(F.col("run") == F.col("window")).select(
        "doc_id", "text_key", "start", "n", "window_id"
    )


def hits(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text_key, start, n, window_id: where documents hold windows, stored.

    ``known`` are distinct windows with their window_id. Rarity counts all documents.
    """
    spark = docs.sparkSession
    shingles = materialise(_shingles(known.dropDuplicates(["window_id"])), "shingles")
    keys = shingles.select("key").distinct()
    weight = F.sum(F.octet_length(F.array_join("window", " ")) + 64)
    taken = shingles.agg(weight).first()[0] or 0
    few = taken <= BROADCAST_BYTES
    small: Callable = F.broadcast if few else (lambda df: df)
    sizes = [row[0] for row in shingles.select("size").distinct().orderBy("size").collect()]  # 1 to SHINGLE
    rows = _keyed(docs)
    counted = _union(
        [_places(rows, k).join(small(keys), "key").groupBy("key").agg(F.count("*").alias("times")) for k in sizes],
        spark, "key bigint, times bigint",
    )
    times = F.coalesce("times", F.lit(0))
    rarest = (
        shingles.join(small(counted), "key", "left")
        .groupBy("window_id")
        .agg(
            F.min_by(F.struct("key", "offset", "n", "window", "size"), F.struct(times, "key", "offset")).alias("p"),
            F.min(times).alias("least"),
        )
        .filter("least > 0")  # else one of its shingles occurs nowhere, and neither does the window
    )
    prefixes = materialise(
        rarest.select("window_id", "p.*").groupBy("key", "size").agg(
            F.collect_list(F.struct("window_id", "offset", "n", "window")).alias("prefixed")
        ),
        "prefixes",
    )

    def verified(k: int) -> DataFrame:
        looked = _places(rows, k, "doc_id", "text_key").join(
            small(prefixes.filter(F.col("size") == k).select("key", "prefixed")), "key"
        )
        laid = looked.select("doc_id", "text_key", "words", "at", F.explode("prefixed").alias("p"))
        start = F.col("at") - F.col("p.offset")
        inside = (start >= 0) & (start + F.col("p.n") <= F.size("words"))
        equal = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("p.n")) == F.col("p.window")
        return laid.filter(inside & equal).select(
            "doc_id", "text_key", start.alias("start"), F.col("p.n").alias("n"), F.col("p.window_id").alias("window_id")
        )

    schema = "doc_id bigint, text_key bigint, start int, n int, window_id bigint"
    if few:
        return materialise(_union([verified(k) for k in sizes], spark, schema), "hits")
    met = _union([_candidates(rows, prefixes, k) for k in sizes], spark, schema)
    return materialise(_verified(rows, met, shingles.select("window_id", "window").distinct()), "hits")


def _known(items: DataFrame, size: int, unnamed: bool = False) -> DataFrame:
    known = windows(items if unnamed else items.filter("item_id is not null"), size)
    return materialise(known.withColumn("window_id", F.xxhash64("window", "n")), "windows")


def find(docs: DataFrame, items: DataFrame, size: int = WINDOW, unnamed: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) for every row of ``docs``.

    A word is hit if it stands in a window of an item. Null texts have no words, and items without
    words hit nothing, nor do those without item_id unless ``unnamed``; then their words are hit, and only
    the list of items leaves them out. Equal rows get equal results; rows of one doc_id with
    different texts are told apart by their text. Whole texts are searched, however long; what is shuffled
    of a document grows with its length. Empty tables of either kind are fine: without items nothing is
    hit. Other columns are not read.
    """
    known = _known(items, size, unnamed)
    places = hits(docs, known)
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "n"))),
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("reach")),
        lambda had, run: F.struct(
            (had["hit"] + F.greatest(F.lit(0), run["start"] + run["n"] - F.greatest(run["start"], had["reach"])))
            .cast("long").alias("hit"),
            F.greatest(had["reach"], run["start"] + run["n"]).alias("reach"),
        ),
        lambda had: had["hit"],
    )
    per_doc = places.groupBy("doc_id", "text_key").agg(covered.alias("n_hit"))
    found = (
        places.select("doc_id", "text_key", "window_id")
        .distinct()
        .join(known.select("window_id", F.col("item_id").cast("string").alias("item")), "window_id")
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    base = _keyed(docs).select("doc_id", "text_key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return _marked(_marked(base, per_doc), found).select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"), items_found.alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW, unnamed: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no window of an item.

    Items without item_id count only with ``unnamed``. Rows with a null text, or one without words, stay;
    equal rows stay or go together; whole texts are searched. Without items all rows stay.
    """
    found = hits(docs, _known(items, size, unnamed)).select(
        F.col("doc_id").isNull().alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key"
    )
    found = materialise(found.distinct(), "contaminated")
    small: Callable = F.broadcast if found.count() * KEY_BYTES <= BROADCAST_BYTES else (lambda df: df)
    rows = packed(
        docs,
        missing=docs["doc_id"].isNull(), id=F.coalesce(docs["doc_id"], F.lit(0)), text_key=F.xxhash64(docs["text"]),
    )
    return unpacked(rows.join(small(found), ["missing", "id", "text_key"], "left_anti"), docs)
