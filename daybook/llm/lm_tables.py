"""Language-model scores by stupid backoff, computed relationally.

Documents are dealt to parts, and the n-grams of a part are exploded to one row each with how often the
part has them. Spark shuffles these rows by the n-gram's hash and sums them, which is the count table,
and a row whose sum is not what its own part has goes back to that part with the sum. There every
document's n-grams take their counts and are summed per document.

Words and pairs are counted first. Longer n-grams follow one length at a time, and only those are
exploded whose two shorter n-grams occur often enough: no other can.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.equal_rows import LAID_AT_ONCE, laid_out, merged_parts, raw_texts
from daybook.llm.lm_scoring import BACKOFF, LEAST_COUNT, ORDER, UNIT
from daybook.llm.rows import parts_of, text_bytes
from daybook.llm.words import ngram_hashes, word_hashes
from daybook.session import materialise

PART_BYTES = 6 << 20  # of text whose n-grams are exploded together

_GRAMS = "part int, gram bigint, times bigint"
_SUMS = "doc_id bigint, copies bigint, words bigint, fell bigint, units bigint"


def _dealt(docs: DataFrame) -> DataFrame:
    return merged_parts(docs, parts_of(text_bytes(docs), PART_BYTES))


def _rounds(order: int) -> list[list[int]]:
    """The lengths that are counted together, in turn."""
    return [list(range(1, min(order, 2) + 1)), *([n] for n in range(3, order + 1))]


class _Part:
    """The n-grams of a part: ``runs[n][k]`` are those of n words of its text k, ``counts`` likewise."""

    def __init__(self, table: pa.Table, order: int, least_count: int):
        self.rounds, self.least = _rounds(order), least_count
        self.words = [word_hashes(raw) for raw in raw_texts(table)]
        self.copies = table.column("copies").to_numpy()
        self.counts: dict[int, list[np.ndarray]] = {}

    def _round(self, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, which may occur often enough, and the different ones of these: grams, place, own count."""
        lengths = self.rounds[turn]
        runs = [ngram_hashes(w, n) for n in lengths for w in self.words] or [np.empty(0, np.uint64)]
        hashes, weights = np.concatenate(runs), np.repeat(np.tile(self.copies, len(lengths)), [len(r) for r in runs])
        wanted = np.ones(len(hashes), bool)
        if turn and self.least > 1:
            shorter = self.counts[lengths[0] - 1]
            wanted = np.concatenate([(c[:-1] >= self.least) & (c[1:] >= self.least) for c in shorter])
        grams, place = np.unique(hashes[wanted], return_inverse=True)
        own = np.bincount(place, weights=weights[wanted], minlength=len(grams)).astype(np.int64)
        return hashes, wanted, grams, place, own

    def exploded(self, part: int, turn: int) -> pa.Table:
        _, _, grams, _, own = self._round(turn)
        return pa.table({
            "part": pa.array(np.full(len(grams), part, np.int32)), "gram": grams.view(np.int64), "times": own
        })

    def look_up(self, answers: pa.Table, turns: int) -> None:
        """Counts over all documents; those without an answer are the part's own."""
        asked = answers.column("gram").to_numpy().view(np.uint64)
        by = np.argsort(asked)
        asked, times = asked[by], answers.column("times").to_numpy()[by]
        for turn in range(turns):
            hashes, wanted, grams, place, own = self._round(turn)
            at = np.searchsorted(asked, grams)
            if len(asked):
                at = np.minimum(at, len(asked) - 1)
                own = np.where(asked[at] == grams, times[at], own)
            counts = np.zeros(len(hashes), np.int64)
            counts[wanted] = own[place]
            lengths = [max(0, len(w) - n + 1) for n in self.rounds[turn] for w in self.words]
            of_text = np.split(counts, np.cumsum(lengths)[:-1])
            for k, n in enumerate(self.rounds[turn]):
                self.counts[n] = of_text[k * len(self.words) : (k + 1) * len(self.words)]


def _units(values: np.ndarray) -> np.ndarray:
    return np.rint(np.log(values) * UNIT).astype(np.int64)


def _sums(counts: list[np.ndarray], backoff: float, least_count: int) -> tuple[int, int]:
    """How many words of a text fall back to the word alone, and its sum without the size of the corpus."""
    units, alone = _units(counts[0]), np.ones(len(counts[0]), bool)
    for shorter, run in zip(counts, counts[1:]):
        skipped = len(units) - len(run)
        often = run >= least_count
        share = _units(np.maximum(run, 1) / np.maximum(shorter[: len(run)], 1))
        units[skipped:] = np.where(often, share, units[skipped:] + round(math.log(backoff) * UNIT))
        alone[skipped:] &= ~often
    return int(alone.sum()), int(units.sum())


def score(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least_count: int = LEAST_COUNT
) -> DataFrame:
    """doc_id, n_words, n_unseen, score_units (long), score (double) for every row of ``docs``.

    A word after its n - 1 predecessors scores count(n-gram) / count(predecessors) with the longest n
    up to ``order`` whose n-gram occurs ``least_count`` times in all documents, times ``backoff`` for
    every n tried in vain; a word alone scores its share of all words. n_unseen is how many words fell
    back to that though a predecessor stood before them. score is the mean natural logarithm over the
    words, score_units the sum in millionths. A null text and one without words have no words and score
    0. Equal rows score alike, are looked at once, and each counts. n-grams do not cross documents, are
    told apart by 64 bits, and are taken from whole texts, however long. An empty table has no scores.
    Only doc_id and text are read, so other columns may have any name.

    A frequent n-gram is one row a part, whatever its places. Nothing is broadcast.
    """
    rows, rounds = _dealt(docs), _rounds(order)

    def explode_first(key: tuple, table: pa.Table) -> pa.Table:
        return _Part(table, order, least_count).exploded(key[0].as_py(), 0)

    def explode_next(turn: int) -> Callable:
        def explode(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
            part = _Part(table, order, least_count)
            part.look_up(answers, turn)
            return part.exploded(key[0].as_py(), turn)

        return explode

    def add_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = _Part(table, order, least_count)
        part.look_up(answers, len(rounds))
        sums = [_sums(list(c), backoff, least_count) for c in zip(*(part.counts[n] for n in range(1, order + 1)))]
        return pa.table({
            "doc_id": table.column("doc_id"), "copies": table.column("copies"),
            "words": pa.array([len(w) for w in part.words], pa.int64()),
            "fell": pa.array([fell for fell, _ in sums], pa.int64()),
            "units": pa.array([units for _, units in sums], pa.int64()),
        })

    parts, answers = rows.groupBy("part"), None
    whole = F.sum("times").over(Window.partitionBy("gram"))
    for turn in range(len(rounds)):
        if answers is None:
            exploded = parts.applyInArrow(explode_first, _GRAMS)
        else:
            exploded = parts.cogroup(answers.groupBy("part")).applyInArrow(explode_next(turn), _GRAMS)
        counted = exploded.withColumn("whole", whole).filter("whole > times")
        counted = counted.select("part", "gram", F.col("whole").alias("times"))
        answers = counted if answers is None else answers.unionByName(counted)
    summed = materialise(parts.cogroup(answers.groupBy("part")).applyInArrow(add_up, _SUMS), "scores")
    n_words = summed.agg(F.sum(F.col("words") * F.col("copies"))).first()[0] or 0
    total = F.col("units") - F.col("fell") * F.lit(round(math.log(n_words) * UNIT) if n_words else 0)
    mean = F.when(F.col("words") > 0, F.col("score_units") / F.col("words") / F.lit(float(UNIT))).otherwise(0.0)
    first = F.when(F.col("words") > 0, 1).otherwise(0)
    return laid_out(summed.withColumn("score_units", total.cast("long")), LAID_AT_ONCE).select(
        "doc_id", F.col("words").alias("n_words"), (F.col("fell") - first).cast("long").alias("n_unseen"),
        "score_units", mean.alias("score"),
    )
