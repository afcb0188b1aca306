"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of all shingles. To find all
pairs within a radius r, every bit gets one of the vectors of r + 1 bits, and for each non-zero vector
v there is a table that compares the bits whose vector has an odd overlap with v. Any r bits span less
than the whole space of vectors, so some v overlaps none of them oddly: however a pair differs in up to
r bits, some table ignores all of them and the pair collides there. No link is left to chance.

Distinct fingerprints are hashed, not documents. A bucket that is still large is covered once more on
the bits its table ignored, after which it cannot exceed what the few bits left can tell apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.rows import packed, unpacked
from daybook.llm.words import pieces, raw_bytes
from daybook.session import materialise

BITS, SHINGLE, DISTANCE, SEED = 64, 3, 3, 42
LARGE_BUCKET = 4096
_HASH = xxhash.xxh64_intdigest
#: Row 256 * k + b of a histogram of bytes by place adds these bits.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(raw: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``size`` words joined by spaces, or of all words if there are fewer."""
    carried: list[bytes] = []
    found = False
    for piece in pieces(raw.lower()):  # bytes.lower changes A-Z only
        words = carried + piece.split()
        if len(words) >= size:
            found = True
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes).tolist()
            yield np.array([_HASH(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())], np.uint64)
        carried = words[len(words) - size + 1 :] if len(words) >= size else words
        if size == 1:
            carried = []
    if not found and carried:
        yield np.array([_HASH(b" ".join(carried), SEED)], np.uint64)


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; 0 for a text without words."""
    counts, total = np.zeros(8 * 256, np.int64), 0
    for hashes in shingle_hashes(raw, size):
        by_place = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
        counts += np.bincount(by_place.ravel(), minlength=8 * 256)
        total += len(hashes)
    ones = (counts.reshape(8, 256) @ _BYTE_BITS).ravel()  # least significant bit first
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key and fp (the fingerprint's bits as a long) for every row, without a shuffle."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(raw_bytes(text.as_py()), size) for text in batch.column("text")]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), fp], ["doc_id", "text_key", "fp"]
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(printed, "doc_id bigint, text_key bigint, fp bigint")


def covering_masks(places: list[int], radius: int) -> list[int]:
    """Masks over the given bits, one of which misses any ``radius`` of them."""
    vectors = 1 << (radius + 1)
    given = {bit: n % (vectors - 1) + 1 for n, bit in enumerate(places)}
    return [sum(1 << bit for bit, m in given.items() if (m & v).bit_count() % 2) for v in range(1, vectors)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _spanning(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that tie the distinct prints of one bucket as all pairs within the radius would."""
    left = prints
    while len(left) > 1:
        left, reached = left[1:], [left[0]]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(left ^ at) <= radius
            for found in left[near]:
                reached.append(found)
                yield at, found
            left = left[~near]


def _links_of(table: np.ndarray, key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by bucket."""
    starts = np.flatnonzero(np.r_[True, (table[1:] != table[:-1]) | (key[1:] != key[:-1])])
    sizes = np.diff(np.r_[starts, len(key)])
    pair = starts[sizes == 2]
    near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= radius]
    more = [
        link
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist())
        for link in _spanning(fp[start : start + size], radius)
    ]
    extra = np.array(more, np.uint64).reshape(-1, 2)
    return np.r_[fp[near], extra[:, 0]], np.r_[fp[near + 1], extra[:, 1]]


def _links(keyed: DataFrame, radius: int) -> DataFrame:
    """u, v: links within the buckets of ``keyed`` (table, key, fp); buckets are read in order."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3

        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            u, v = _links_of(rows[0], rows[1], rows[2].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            fresh = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("table", "key", "fp")]
            rows = [np.r_[h, f] for h, f in zip(held, fresh)]
            if not len(rows[0]):
                continue
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])  # may go on in the next batch
            cut = int(np.argmax(last))
            held = [r[cut:] for r in rows]
            if cut:
                yield out([r[:cut] for r in rows])
        if len(held[0]):
            yield out(held)

    ordered = keyed.repartition("table", "key").sortWithinPartitions("table", "key")
    return ordered.mapInArrow(linked, "u bigint, v bigint")


def _tables(masks: list[tuple[int, int]]) -> Column:
    """Numbers and masks of tables as an array."""
    one = [F.struct(F.lit(n).cast("long").alias("table"), F.lit(_signed(m)).alias("mask")) for n, m in masks]
    return F.array(*one)


def _keyed(prints: DataFrame, tables: Column) -> DataFrame:
    """table, key, fp: every fingerprint in each of its tables."""
    return prints.select("fp", F.explode(tables).alias("t")).select(
        F.col("t.table").alias("table"), F.col("fp").bitwiseAND(F.col("t.mask")).alias("key"), "fp"
    )


def near_links(prints: DataFrame, radius: int = DISTANCE) -> DataFrame:
    """u, v: links that tie the distinct fingerprints ``fp`` as all pairs within ``radius`` bits would."""
    masks = covering_masks(list(range(BITS)), radius)
    keyed = _keyed(prints, _tables(list(enumerate(masks))))
    sizes = keyed.groupBy("table", "key").count()
    large = materialise(sizes.filter(F.col("count") > LARGE_BUCKET).select("table", "key"), "large")
    found = _links(keyed.join(large, ["table", "key"], "left_anti"), radius)

    finer, number = [], len(masks)
    for mask in masks:
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        further = [mask | more for more in covering_masks(free, radius)]
        finer.append(_tables(list(enumerate(further, number))))
        number += len(further)
    crowded = keyed.join(large, ["table", "key"], "left_semi")
    twice = _keyed(crowded, F.get(F.array(*finer), F.col("table").cast("int")))
    return found.unionByName(_links(twice, radius))


def _grouped(docs: DataFrame, size: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, fp), stored, and every distinct fingerprint's group (fp, root)."""
    rows = materialise(fingerprints(docs, size), "fingerprints")
    prints = materialise(rows.select("fp").distinct(), "prints")
    roots = components(near_links(prints, radius))
    grouped = prints.join(roots, F.col("fp") == F.col("node"), "left")
    return rows, grouped.select("fp", F.coalesce("root", "fp").alias("root"))


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Rows whose fingerprints are tied by steps of at most ``radius`` bits share a component, named by
    its smallest doc_id; null only if all its rows lack one. Null and empty texts, and texts without
    words, have fingerprint zero and are linked like any other. Equal texts share a fingerprint and are compared
    once, so a group of copies costs one row. Columns other than doc_id and text are not read.
    """
    rows, grouped = _grouped(docs, size, radius)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = grouped.join(least, "fp")
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = materialise(named.join(component, "root").select("fp", "component_id"), "component")
    return rows.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, size: int = SHINGLE, radius: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` of each group: that of the smallest doc_id, a missing one last.

    Of rows with the same doc_id the text decides, by a hash; of equal rows any one stays.
    """
    rows, grouped = _grouped(docs, size, radius)
    missing, number = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    order = F.struct(missing.alias("missing"), number.alias("id"), "text_key")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = grouped.join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    whole = packed(
        docs,
        missing=docs["doc_id"].isNull(), id=F.coalesce(docs["doc_id"], F.lit(0)), text_key=F.xxhash64(docs["text"]),
    )
    same = ["missing", "id", "text_key"]
    return unpacked(whole.join(chosen, same).dropDuplicates(same), docs)
