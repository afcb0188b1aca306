"""A quality classifier by compression.

Two zstandard dictionaries are built from labelled text, one from good and one from bad. A text is
compressed with either, and the difference of the sizes, normalised by its length, becomes a score by
a calibrated logistic curve. Texts are compressed in short chunks that know the dictionary but not
each other; else the dictionary would count for little in long texts and for nothing in repetitive
ones, which compress well against anything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import labelled
from daybook.llm.rows import packed, unpacked

CHUNK = 256
LEVEL = 3
DICTIONARY_BYTES = 1 << 16
CHUNKS_OF_TEXT = 32  # of each sampled text, evenly spread, for the dictionary
THRESHOLD = 0.3
#: Bytes added to either side of difference over length, so that a few bytes say little.
MORE_SAVED, MORE_LENGTH = 2, 50


def chunks(raw: bytes) -> Iterator[bytes]:
    for at in range(0, len(raw), CHUNK):
        yield raw[at : at + CHUNK]


def _spread(raw: bytes, most: int | None) -> list[bytes]:
    step = max(1, math.ceil(len(raw) / CHUNK / most) if most else 1) * CHUNK
    return [raw[at : at + CHUNK] for at in range(0, len(raw), step)]


def build_dictionary(texts: list[bytes], most: int | None = CHUNKS_OF_TEXT) -> bytes:
    """Dictionary bytes; the texts themselves where there are too few to train on; b"" for none."""
    pieces = [piece for text in texts for piece in _spread(text, most)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def without_shared_lines(good: list[bytes], bad: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Lines that texts of both labels hold say nothing of quality."""
    shared = {line for t in good for line in t.split(b"\n")} & {line for t in bad for line in t.split(b"\n")}
    return tuple(
        [b"\n".join(line for line in t.split(b"\n") if line not in shared) for t in texts] for texts in (good, bad)
    )


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for dictionary in (self.good, self.bad):
            data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            if data:
                data.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False))
        return made

    def score(self, difference: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * difference + self.intercept))))


def difference(raw: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """How much less room the text takes with the good dictionary, over its length."""
    saved = sum(len(bad.compress(piece)) - len(good.compress(piece)) for piece in chunks(raw))
    return (saved + MORE_SAVED) / (len(raw) + MORE_LENGTH)


def train(
    docs: DataFrame, labels: DataFrame, chunks_of_text: int | None = CHUNKS_OF_TEXT, **bounds
) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out.

    Two thirds of the sample build the dictionaries and the rest calibrates, weighted to the share of
    good rows among all labels. A dictionary sees up to ``chunks_of_text`` chunks of a text, evenly spread,
    or all of them with None. Without labels every text gets the same score.
    """
    rows = labelled.sample(docs, labels, **bounds)
    texts = [[r.raw for r in rows if not r.calibrates and r.label == label] for label in (1, 0)]
    good, bad = (build_dictionary(t, chunks_of_text) for t in without_shared_lines(*texts))
    model = Model(good, bad, 0.0, 0.0)
    pair = model.compressors()
    measured = [(difference(r.raw, *pair), r.label) for r in rows if r.calibrates]
    values, marks = np.array(measured, dtype=float).reshape(-1, 2).T
    return Model(good, bad, *labelled.calibrated(values, marks, labelled.share_of_good(labels)))


def scored(text: Column, model: Model) -> Column:
    """The score of a text (0 to 1, higher: better), in Arrow batches; a null text scores as empty."""

    @F.arrow_udf("double")
    def score_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair = model.compressors()
        for batch in batches:
            raw = ((t.as_py() or "").encode("utf-8", "replace") for t in batch)
            yield pa.array([model.score(difference(r, *pair)) for r in raw], pa.float64())

    return score_batches(text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for every row of ``docs``; no other column than doc_id and text is read.

    Whole texts are read, in one pass without a shuffle; the model is two dictionaries of bounded size.
    Equal texts get equal scores. An empty table gives an empty table.
    """
    return docs.select("doc_id", scored(F.col("text"), model).alias("score"))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score reaches ``threshold``."""
    rows = packed(docs, score=scored(docs["text"], model))
    return unpacked(rows.filter(F.col("score") >= threshold), docs)
