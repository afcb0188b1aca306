"""Language-model scores by stupid backoff.

The n-grams of all documents are counted in tables partitioned by their hash, and every document's own
n-grams look up their counts there and are summed per document. A part of the documents sends each
n-gram once, with how often the part has it, and gets the count over all documents back, so a frequent
n-gram costs one entry a part and not one a place.

Words and pairs are counted first. Longer n-grams follow one length at a time, and only those are sent
whose two shorter n-grams occur often enough: no other can.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.blobs import by_bucket, dealt, pack, pack_sorted, rows_table, texts_of, unpack, unpack_sorted
from daybook.llm.rows import parts_of, text_bytes
from daybook.llm.words import ngram_hashes, word_hashes
from daybook.session import materialise

ORDER, BACKOFF, LEAST_COUNT = 2, 0.4, 2
#: Log scores are summed as whole millionths, so that sums do not depend on their order.
UNIT = 1_000_000
BUCKET_BYTES = 4 << 20  # of text whose n-grams a bucket counts
PART_BYTES = 6 << 20  # of text whose n-grams are sent once

_SENT = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("grams", pa.binary()), ("times", pa.binary())])
_COUNTED = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary())])
_SENT_SQL = "bucket int, part int, grams binary, times binary"
_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_unseen", pa.int64()), ("units", pa.int64())]
)


def _rounds(order: int) -> list[list[int]]:
    """The lengths that are counted together, in turn."""
    return [list(range(1, min(order, 2) + 1)), *([n] for n in range(3, order + 1))]


def _grams(
    words: list[np.ndarray], lengths: list[int], below: list[np.ndarray], least_count: int
) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a round by n and text by text, and which of them can occur ``least_count`` times.

    ``below`` are the counts of the n-grams one word shorter, text by text, where they are known.
    """
    hashes = [ngram_hashes(w, n) for n in lengths for w in words]
    hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    if not below or least_count <= 1:
        return hashes, np.ones(len(hashes), bool)
    return hashes, np.concatenate([(c[:-1] >= least_count) & (c[1:] >= least_count) for c in below])


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte of each place, since most are small."""
    return pack(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T)


def _numbers(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(blob, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _units(values: np.ndarray) -> np.ndarray:
    return np.rint(np.log(values) * UNIT).astype(np.int64)


def score(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least_count: int = LEAST_COUNT
) -> DataFrame:
    """doc_id, n_words, n_unseen, score_units (long), score (double) for every row of ``docs``.

    A word after its n - 1 predecessors scores count(n-gram) / count(predecessors) with the longest n
    up to ``order`` whose n-gram occurs ``least_count`` times in all documents, times ``backoff`` for
    every n tried in vain; a word alone scores its share of all words. n_unseen is how many words fell
    back to that though a predecessor stood before them. score is the mean natural logarithm over the
    words, score_units the sum in millionths. A null text and one without words have no words and score
    0. Equal texts score alike and each counts. n-grams do not cross documents. Only doc_id and text
    are read.
    """
    total = text_bytes(docs)
    rows, _ = dealt(docs, total, PART_BYTES)
    buckets = parts_of(total, BUCKET_BYTES)

    rounds = _rounds(order)

    def send(part: int, hashes: np.ndarray) -> pa.Table:
        grams, times = np.unique(hashes, return_counts=True)
        by, slices = by_bucket(grams, buckets)
        of = grams // np.uint64(buckets)  # the rest of the division is the bucket
        return rows_table([(b, part, pack_sorted(of[by[s]]), _planes(times[by[s]])) for b, s in slices], _SENT)

    def count(table: pa.Table) -> pa.Table:
        grams = [unpack_sorted(b.as_py()) for b in table.column("grams")]
        times = [_numbers(b.as_py()) for b in table.column("times")]
        _, which = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate(times)).astype(np.int64)[which]
        cuts = np.cumsum([len(g) for g in grams])[:-1]
        out = [
            (part.as_py(), bucket.as_py(), _planes(of))
            for part, bucket, of in zip(table.column("part"), table.column("bucket"), np.split(counts, cuts))
        ]
        return rows_table(out, _COUNTED)

    def looked_up(words: list[np.ndarray], answers: pa.Table, turns: int) -> list[list[np.ndarray]]:
        """The counts after so many rounds by n, text by text; 0 for n-grams that were not sent."""
        got = {
            (t.as_py(), b.as_py()): c.as_py()
            for t, b, c in zip(answers.column("turn"), answers.column("bucket"), answers.column("counts"))
        }
        found: list[list[np.ndarray]] = []
        for turn, lengths in enumerate(rounds[:turns]):
            hashes, sent = _grams(words, lengths, found[-1] if found else [], least_count)
            grams, which = np.unique(hashes[sent], return_inverse=True)
            of_gram = np.zeros(len(grams), np.int64)
            by, slices = by_bucket(grams, buckets)
            for b, s in slices:
                of_gram[by[s]] = _numbers(got[turn, b])
            counts = np.zeros(len(hashes), np.int64)
            counts[sent] = of_gram[which]
            cuts = np.cumsum([max(0, len(w) - n + 1) for n in lengths for w in words])[:-1]
            split = np.split(counts, cuts)
            found += [split[k * len(words) : (k + 1) * len(words)] for k in range(len(lengths))]
        return found

    def send_first(key: tuple, table: pa.Table) -> pa.Table:
        words = [word_hashes(raw) for raw in texts_of(table)]
        return send(key[0].as_py(), _grams(words, rounds[0], [], least_count)[0])

    def sender(turn: int):
        def send_next(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            words = [word_hashes(raw) for raw in texts_of(left)]
            below = looked_up(words, right, turn)[-1]
            hashes, sent = _grams(words, rounds[turn], below, least_count)
            return send(key[0].as_py(), hashes[sent])

        return send_next

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        words, out = [word_hashes(raw) for raw in texts_of(left)], []
        for doc_id, own, counted in zip(left.column("doc_id"), words, zip(*looked_up(words, right, len(rounds)))):
            # units of the word alone leave out the size of the corpus, which only the sum knows
            units, alone = _units(counted[0]), np.ones(len(own), bool)
            for n in range(2, order + 1):
                had, run = counted[n - 2], counted[n - 1]
                seen = run >= least_count
                before = units[n - 1 :] + round(math.log(backoff) * UNIT)
                share = np.maximum(run, 1) / np.maximum(had[: len(run)], 1)
                units[n - 1 :] = np.where(seen, _units(share), before)
                alone[n - 1 :] &= ~seen
            out.append((doc_id.as_py(), len(own), int(alone.sum()), int(units.sum())))
        return rows_table(out, _SCORED)

    parts, answers = rows.groupBy("part"), None
    for turn in range(len(rounds)):
        if answers is None:
            sent = parts.applyInArrow(send_first, _SENT_SQL)
        else:
            sent = parts.cogroup(answers.groupBy("part")).applyInArrow(sender(turn), _SENT_SQL)
        counted = sent.groupBy("bucket").applyInArrow(count, "part int, bucket int, counts binary")
        counted = counted.select(F.lit(turn).alias("turn"), "part", "bucket", "counts")
        answers = counted if answers is None else answers.unionByName(counted)
    summed = parts.cogroup(answers.groupBy("part")).applyInArrow(
        add_up, "doc_id bigint, n_words bigint, n_unseen bigint, units bigint"
    )
    summed = materialise(summed, "scores")
    words = summed.agg(F.sum("n_words")).first()[0] or 0
    whole = F.col("units") - F.col("n_unseen") * F.lit(round(math.log(words) * UNIT) if words else 0)
    mean = F.when(F.col("n_words") > 0, F.col("score_units") / F.col("n_words") / F.lit(float(UNIT))).otherwise(0.0)
    first = F.when(F.col("n_words") > 0, 1).otherwise(0)
    return (
        summed.withColumn("score_units", whole)
        .select(
            "doc_id", "n_words", (F.col("n_unseen") - first).cast("long").alias("n_unseen"),
            F.col("score_units").cast("long"), mean.alias("score"),
        )
    )
