"""Cross-tokenizer alignment: which tokens of one tokenizer stand where tokens of another stand.

Tokenizer A reads a space and the text, tokenizer B the text, before which it puts a space itself, so
both cut the same bytes. Each gives a token-byte incidence matrix. The product A·Bᵀ, row by row, has a
cell for every pair of tokens that share bytes; the pairs among them whose ranges end together are the
ends of groups. Tokens and groups give two more matrices, whose product pairs the tokens of a group.

Words repeat, so the products are taken once for each distinct chunk, a run of white space and what
follows up to the next. Both tokenizers end a token at the end of a chunk: A splits there before
it merges, and no piece of B goes over it, which is looked up in its vocabulary. A text with characters
for which that is not sure is one chunk as a whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.incidence import Csr, of_labels, of_ranges, product, products
from daybook.session import materialise
from daybook.sources.files import row_id

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"  # fixed value: how tokenizer B writes a space
#: Control characters and one format character of which tokenizers do not agree whether they are white space.
_UNSURE = "\x1c-\x1f᠎"
PIECE, MOST_HELD, MOST_CELLS = 1 << 20, 256 << 20, 1 << 22
LEAD = " a"  # stands before chunks that are encoded apart from their text


@dataclass(frozen=True)
class Tokenizers:
    """The two vocabulary files, read on the driver (some 2 MB) and sent along with the tasks."""

    a: bytes
    b: bytes

    @classmethod
    def read(cls, folder: str) -> "Tokenizers":
        with open(f"{folder}/{A_FILE}", "rb") as a, open(f"{folder}/{B_FILE}", "rb") as b:
            return cls(a.read(), b.read())


def _byte_of_mark() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones are themselves,
    the others follow from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Token ids and byte ends of a text under both tokenizers."""

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores of a machine are Spark's to deal
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(files.a.decode("utf-8"))
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        byte_of = _byte_of_mark()
        described = json.loads(files.a)
        self.a_bytes = [b""] * self._a.get_vocab_size(with_added_tokens=True)
        for piece, number in described["model"]["vocab"].items():
            self.a_bytes[number] = bytes(byte_of[c] for c in piece)
        for added in described["added_tokens"]:
            self.a_bytes[added["id"]] = added["content"].encode("utf-8")
        self.b_bytes, wide = [], set()
        for number in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(number)
            if self._b.is_byte(number):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace(SPACE_MARK, " ").encode("utf-8"))
                wide.update(piece[1:].lstrip(SPACE_MARK) if piece[0] == SPACE_MARK else piece[1:])
                wide.update(piece[0] if len(piece) > 1 and piece[0] != SPACE_MARK else "")
        self._a_sizes = np.array(list(map(len, self.a_bytes)), np.int64)
        self._b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        spaces = [c for c in " \t\n\v\f\r\x85\xa0" if c != " " and c not in wide]
        if SPACE_MARK not in wide:  # no piece goes on over a space
            spaces.append(" ")
        cut = "".join(map(re.escape, spaces)) or "(?!)"
        self.chunk = re.compile(f"[{cut}]*[^{cut}]+|[{cut}]+")
        self.cut = re.compile(f"(?<=[^{cut}])(?=[{cut}])")
        self.whole = re.compile(rf"(?![{cut}])[\s{_UNSURE}]")  # white space that is not sure to end a token

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and ends under A, ids and ends under B, of a text that begins with a space; None where
        the bytes of the tokens are not those of the text."""
        raw = text.encode("utf-8")
        a = self._a.encode(text, add_special_tokens=False).ids
        b = self._b.encode(text[1:])
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return a, np.cumsum(self._a_sizes[a]), b, np.cumsum(self._b_sizes[b])


def end_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of A and of B that end together, from the overlaps A·Bᵀ."""
    n_bytes = int(a_ends[-1]) if len(a_ends) else 0
    a, b = of_ranges(a_ends, n_bytes), of_ranges(b_ends, n_bytes)
    row, column, _ = product(a, b.transposed())
    together = a_ends[row] == b_ends[column]
    return row[together], column[together]


def group_matrices(a_ends: np.ndarray, b_ends: np.ndarray, at: np.ndarray) -> tuple[Csr, Csr]:
    """Token-group incidence of A and of B; ``at`` has the places of A's tokens that end a group."""
    cuts = a_ends[at]
    return of_labels(np.searchsorted(cuts, a_ends), len(cuts)), of_labels(np.searchsorted(cuts, b_ends), len(cuts))


def written(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[str]:
    """Groups, each as a1,a2|b1; ``i`` and ``j`` are the places of the tokens that end them."""
    a, b, said, x, y = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
    for m, n in zip(i.tolist(), j.tolist()):
        said.append(f"{','.join(a[x : m + 1])}|{','.join(b[y : n + 1])}")
        x, y = m + 1, n + 1
    return said


@dataclass(frozen=True)
class Aligned:
    """A text under both tokenizers: numbers of tokens, linked pairs and groups."""

    n_a: int
    n_b: int
    pairs: np.ndarray  # id of A times the size of B's vocabulary, plus id of B, of every link
    groups: str


class Chunks:
    """What is known of chunks: a number for each, and by number its tokens, links and groups."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.first = (np.zeros(1 << 12, np.int32) for _ in range(3))
        self.pairs = np.zeros(1 << 14, np.int64)
        self.n_pairs = self.held = 0

    def add(self, chunks: list[str], n_a: np.ndarray, n_b: np.ndarray, ends: np.ndarray, pairs: np.ndarray,
            groups: list[str]) -> None:
        """``ends`` has the end of each chunk's links among ``pairs``."""
        old, new = len(self.groups), len(self.groups) + len(chunks)
        while new + 1 > len(self.first):
            self.n_a, self.n_b, self.first = (np.r_[v, np.zeros_like(v)] for v in (self.n_a, self.n_b, self.first))
        while self.n_pairs + len(pairs) > len(self.pairs):
            self.pairs = np.r_[self.pairs, np.zeros_like(self.pairs)]
        self.number.update(zip(chunks, range(old, new)))
        self.groups += groups
        self.n_a[old:new], self.n_b[old:new], self.first[old + 1 : new + 1] = n_a, n_b, self.n_pairs + ends
        self.pairs[self.n_pairs : self.n_pairs + len(pairs)] = pairs
        self.n_pairs += len(pairs)
        self.held += sum(map(len, groups)) + sum(map(len, chunks)) + 250 * len(chunks)

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """The pairs of all links of the chunks of a text."""
        first = self.first[numbers].astype(np.int64)
        sizes = self.first[numbers + 1] - first
        ends = np.cumsum(sizes)
        return self.pairs[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Aligner:
    """Aligns texts of one task; keeps what it found for chunks, within a bound on the bytes held."""

    def __init__(self, files: Tokenizers):
        self.encoder = Encoder(files)
        self.n_b = len(self.encoder.b_bytes)
        self.known = Chunks()

    def whole(self, text: str) -> Aligned | None:
        """A text that begins with a space, as one chunk."""
        found = self.encoder.encode(text)
        if found is None:
            return None
        a, a_ends, b, b_ends = found
        i, j = end_links(a_ends, b_ends)
        return Aligned(len(a), len(b), a[i] * self.n_b + b[j], ";".join(written(a, b, i, j)))

    def _learn(self, chunks: list[str]) -> bool:
        """Aligns chunks, laid out one after the other as a text; False where they do not cut there."""
        found = self.encoder.encode(LEAD + "".join(chunks))
        if found is None:
            return False
        a, a_ends, b, b_ends = found
        i, j = end_links(a_ends, b_ends)
        ends = len(LEAD) + np.r_[0, np.cumsum([len(c.encode("utf-8")) for c in chunks])]
        last = np.searchsorted(a_ends[i], ends)  # the link that ends each chunk, and the one before
        if last[-1] >= len(i) or (a_ends[i][last] != ends).any():
            return False
        said, at = written(a, b, i, j), (last + 1).tolist()
        groups = [";".join(said[x:y]) for x, y in zip(at, at[1:])]
        pairs = (a[i] * self.n_b + b[j])[at[0] :]
        self.known.add(chunks, np.diff(i[last]), np.diff(j[last]), last[1:] + 1 - at[0], pairs, groups)
        return True

    def learn(self, chunks: list[str]) -> list[str]:
        """Adds chunks to what is known; returns those that do not give their bytes back."""
        odd = []
        for first in range(0, len(chunks), 4096):
            some = chunks[first : first + 4096]
            if not self._learn(some):
                odd += [chunk for chunk in some if not self._learn([chunk])]
        return odd

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about ``PIECE`` characters that end where chunks end."""
        at = 0
        while at < len(text):
            cut = self.encoder.cut.search(text, at + PIECE)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def numbers(self, text: str) -> Iterator[np.ndarray | None]:
        """The numbers of a text's chunks, piece by piece; None once where they cannot stand for the text."""
        if self.encoder.whole.search(text) or text.isspace():
            yield None
            return
        for piece in self.pieces(text):
            chunks = self.encoder.chunk.findall(piece)
            if self.known.held > MOST_HELD:
                self.known = Chunks()
            fresh = set(chunks).difference(self.known.number)
            # white space alone ends a text and goes last, where no other chunk follows it
            if fresh and any([self.learn(sorted(c for c in fresh if not c.isspace())),
                              *(self.learn([c]) for c in fresh if c.isspace())]):
                yield None
                return
            yield np.fromiter(map(self.known.number.__getitem__, chunks), np.int64, len(chunks))

    def document(self, text: str) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_links, digest of the groups, distinct pairs and how often each is linked."""
        text, digest, n_a, n_b, n_links = " " + text, hashlib.sha256(), 0, 0, 0
        pairs = times = np.empty(0, np.int64)
        for numbers in self.numbers(text):
            if numbers is None:
                found = self.whole(text)
                if found is None:
                    return NOTHING
                pairs, times = np.unique(found.pairs, return_counts=True)
                groups = hashlib.sha256(found.groups.encode()).hexdigest()
                return found.n_a, found.n_b, len(found.pairs), groups, pairs, times
            known = self.known
            digest.update((";" if n_a else "").encode())
            digest.update(";".join(map(known.groups.__getitem__, numbers.tolist())).encode())
            n_a += int(known.n_a[numbers].sum())
            n_b += int(known.n_b[numbers].sum())
            linked = known.links(numbers)
            n_links += len(linked)
            fresh, often = np.unique(linked, return_counts=True)
            if not len(pairs):
                pairs, times = fresh, often
                continue
            pairs, where = np.unique(np.r_[pairs, fresh], return_inverse=True)
            times = np.bincount(where, np.r_[times, often], len(pairs)).astype(np.int64)
        return n_a, n_b, n_links, digest.hexdigest(), pairs, times


NOTHING = (0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
_ALIGNERS: dict[Tokenizers, Aligner] = {}


def aligner(files: Tokenizers) -> Aligner:
    """The aligner of this worker, which keeps its chunks from task to task."""
    if files not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[files] = Aligner(files)
    return _ALIGNERS[files]


def _decoded(raw: bytes | None) -> str | None:
    try:
        return None if raw is None else raw.decode("utf-8")
    except UnicodeDecodeError:  # no token bytes can equal such a text
        return None


def align(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of every row of ``docs``.

    ``pairs`` has the distinct id pairs (A's id times the size of B's vocabulary, plus B's id) that end
    together in the text, ``times`` how often each does. A null or empty text, and one whose bytes either
    tokenizer does not give back, has no tokens: zeros, an empty text and empty arrays. Texts of any
    length are read in pieces; one with unusual white space is encoded as a whole. Repeated rows give
    equal rows, an empty table an empty one, and other columns are not read.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(files)
        for batch in batches:
            held, ids, size = [], [], 0
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = _decoded(raw.as_py())
                held.append(own.document(text) if text else NOTHING)
                ids.append(doc_id)
                size += len(held[-1][4])
                if size > MOST_CELLS:
                    yield _batch(ids, held)
                    held, ids, size = [], [], 0
            yield _batch(ids, held)

    kind = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, times array<bigint>"
    )
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(aligned, kind)


def _batch(ids: list, held: list) -> pa.RecordBatch:
    def lists(n: int) -> pa.Array:
        offsets = np.r_[0, np.cumsum([len(h[n]) for h in held])].astype(np.int32)
        values = np.concatenate([h[n] for h in held]) if held else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    numbers = [pa.array([h[n] for h in held], pa.int64()) for n in range(3)]
    n_a, n_b, n_links = numbers
    columns = [
        pa.array(ids, pa.int64()), n_a, n_b, n_links, n_links,  # every group ends in one link
        pa.array([h[3] for h in held], pa.string()), lists(4), lists(5),
    ]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    return pa.RecordBatch.from_arrays(columns, names)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, count (links of the whole corpus) and best, whether no pair of its B id has more."""
    linked = aligned.select(F.inline(F.arrays_zip("pairs", "times"))).toDF("pair", "times")
    counts = materialise(linked.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    counts = counts.withColumn("b", F.col("pair") % n_b)
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def link_strength(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    A pair's count is the number of its links in all documents. ``n_best`` counts the links of a document
    whose pair has the highest count of all pairs with its B id, ``count_sum`` adds the counts of its
    links. The alignments are stored once. A pair of frequent words stands once in each document, so the
    join with the counts, which Spark broadcasts below its size limit and else shuffles, splits it.
    """
    n_b = len(Encoder(files).b_bytes)
    aligned = materialise(align(docs, files), "aligned")
    counts = materialise(pair_counts(aligned, n_b), "pairs")
    rows = aligned.select("*", row_id())
    links = rows.select("row_id", F.inline(F.arrays_zip("pairs", "times"))).toDF("row_id", "pair", "times")
    weighed = links.join(counts, "pair").groupBy("row_id").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    none = F.lit(0).cast("bigint")
    return rows.drop("pairs", "times").join(weighed, "row_id", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )


KINDS = ("overlap", "end", "group")


def token_links(docs: DataFrame, files: Tokenizers, kind: str = "overlap") -> DataFrame:
    """doc_id, a_at, b_at, a_id, b_id and weight of every link of every text, places counted from 0.

    ``overlap`` links tokens that share bytes and weighs them by how many, ``end`` those among them that
    end together, ``group`` all tokens of a group with each other, by blocks of rows of the product, so
    that a long group is never held as a whole. Texts without tokens have no links.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {', '.join(KINDS)}")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(files).encoder
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = _decoded(raw.as_py())
                found = own.encode(" " + text) if text else None
                if found is None:
                    continue
                a, a_ends, b, b_ends = found
                left, right = of_ranges(a_ends, a_ends[-1]), of_ranges(b_ends, a_ends[-1])
                if kind == "group":
                    left, right = group_matrices(a_ends, b_ends, end_links(a_ends, b_ends)[0])
                for row, column, weight in products(left, right.transposed(), MOST_CELLS):
                    if kind == "end":
                        kept = a_ends[row] == b_ends[column]
                        row, column, weight = row[kept], column[kept], weight[kept]
                    values = [row, column, a[row], b[column], weight]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(row), pa.int64()), *(pa.array(v.astype(np.int64)) for v in values)],
                        ["doc_id", "a_at", "b_at", "a_id", "b_id", "weight"],
                    )

    shape = "doc_id bigint, a_at bigint, b_at bigint, a_id bigint, b_id bigint, weight bigint"
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(linked, shape)
