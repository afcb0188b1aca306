"""Quality rules: plain counts with fixed limits, then a logistic regression on hashed n-grams.

The regression sees the shares of hashed character and word n-grams of a text, is trained on a bounded
sample of labelled rows, calibrated on rows it was not trained on, and scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm import labelled
from daybook.llm.words import mixed, ngram_hashes, pieces, raw_bytes, word_hashes

# The symbols and limits of the plain rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30

BITS = 11  # of the hash of each kind of n-gram
CHARS = (3, 4)
WORDS = (1, 2)
WIDTH = (len(CHARS) + len(WORDS)) << BITS
ROUNDS, RIDGE = 150, 1e-4
THRESHOLD = 0.3
_SAME = np.uint64(1)


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64) + (kind << BITS)


def _char_hashes(raw: bytes, n: int) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8).astype(np.uint64)
    count = max(0, len(data) - n + 1)
    found = np.zeros(count, np.uint64)
    for k in range(n):
        found = (found << np.uint64(8)) | data[k : k + count]
    return mixed(mixed(found + np.uint64(n)))


def slots_of(raw: bytes, words: np.ndarray) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text as slots of the weights, piece by piece.

    A word that repeats the one before it is hashed as a mark of its own, whatever the word.
    """
    for piece in pieces(raw):
        for kind, n in enumerate(CHARS):
            yield _slots(_char_hashes(piece, n), kind)
    told = words.copy()
    told[1:][words[1:] == words[:-1]] = _SAME
    for kind, n in enumerate(WORDS, len(CHARS)):
        yield _slots(mixed(ngram_hashes(told, n)), kind)


def features(raw: bytes) -> np.ndarray:
    """The share of every slot among the n-grams of its kind."""
    counts = np.zeros(WIDTH)
    for slots in slots_of(raw, word_hashes(raw)):
        counts += np.bincount(slots, minlength=WIDTH)
    kinds = counts.reshape(-1, 1 << BITS)
    return (kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)).ravel()


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float

    def margin(self, raw: bytes, words: np.ndarray) -> float:
        total, kinds = np.zeros(WIDTH >> BITS), np.zeros(WIDTH >> BITS)
        for slots in slots_of(raw, words):
            if len(slots):
                kind = slots[0] >> BITS
                total[kind] += self.weights[slots].sum()
                kinds[kind] += len(slots)
        return float((total / np.maximum(kinds, 1)).sum()) + self.bias

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -30, 30))))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression, labels weighted alike.

    Accelerated gradient steps on features scaled to unit spread, step size from the largest
    curvature; the scale is folded into the weights.
    """
    if len(set(y.tolist())) < 2:
        return np.zeros(x.shape[1]), 0.0
    centre = x.mean(axis=0)
    z = x - centre
    spread = z.std(axis=0) + np.float32(1e-4)
    z /= spread
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    probe = np.ones(z.shape[1], np.float32) / np.sqrt(z.shape[1])
    for _ in range(20):  # power steps
        probe = z.T @ ((weight * (z @ probe)).astype(np.float32))
        largest = float(np.linalg.norm(probe)) + 1e-12
        probe /= largest
    rate = 1 / (0.25 * 1.1 * (largest + 1) + RIDGE)
    w = ahead = np.zeros(z.shape[1])
    b = ahead_b = 0.0
    for n in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead.astype(np.float32) + ahead_b, -30, 30)))
        error = weight * (p - y)
        next_w = ahead - rate * (z.T @ error.astype(np.float32) + RIDGE * ahead)
        next_b = ahead_b - rate * float(error.sum())
        push = n / (n + 3)
        ahead, ahead_b = next_w + push * (next_w - w), next_b + push * (next_b - b)
        w, b = next_w, next_b
    return w / spread, b - float((w / spread) @ centre)


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """A model from a bounded sample of labelled rows: two thirds to train, the rest to calibrate."""
    rows = labelled.sample(docs, labels, **bounds)
    x = np.empty((len(rows), WIDTH), np.float32)
    for n, row in enumerate(rows):
        x[n] = features(row.raw)
    y, later = np.array([r.label for r in rows]), np.array([r.calibrates for r in rows], bool)
    weights, bias = fit(x[~later], y[~later])
    margins = x[later].astype(float) @ weights + bias
    return Model(weights, bias, *labelled.calibrated(margins, y[later], labelled.share_of_good(labels)))


def plain_counts(raw: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = np.frombuffer(raw, np.uint8)
    spaces = np.count_nonzero((data == 32) | ((data >= 9) & (data <= 13)))
    later_bytes = np.count_nonzero((data & 0xC0) == 0x80)  # of characters of several bytes
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, repeated = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip():
            seen.add(line)
    windows = ngram_hashes(words, REPEAT_WINDOW)
    ordered = np.sort(windows)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = 0
    if len(twice):
        at = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        starts = np.flatnonzero(twice[at] == windows)
        fresh = np.minimum(np.diff(starts, append=starts[-1] + REPEAT_WINDOW), REPEAT_WINDOW)
        covered = int(fresh.sum())
    return len(words), len(raw) - int(spaces + later_bytes), symbols, repeated, covered


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, probability double, kept boolean"
)
_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, probability and verdict for every row of ``docs``, in one pass without a shuffle.

    A null or empty text has no words, so it fails the plain rules. Equal texts get equal rows. Texts
    are read whole. Columns other than doc_id and text are not read.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                raw = raw_bytes(text.as_py())
                words = word_hashes(raw)
                counts = plain_counts(raw, words)
                failed = base_failed(counts[0], counts[4])
                p = model.probability(model.margin(raw, words))
                rows.append((*counts, failed, p, not failed and p >= threshold))
            columns = zip(*rows) if rows else [[]] * len(_TYPES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, _TYPES))], _NAMES
            )

    return docs.select("doc_id", "text").mapInArrow(judged, SCHEMA)
