"""Words of a text as hashes, for operators that look at n-grams in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_HASH = xxhash.xxh64_intdigest
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def raw_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut at white space only."""
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + size)
        end = space.start() if space else len(raw)
        yield raw[at:end]
        at = end


def word_hashes(raw: bytes) -> np.ndarray:
    """XXH64 of every word; bytes.split cuts at exactly the white space that separates words."""
    parts = [np.array([_HASH(w) for w in piece.split()], np.uint64) for piece in pieces(raw)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return h ^ (h >> _SHIFT)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words; none if there are fewer."""
    count = max(0, len(words) - n + 1)
    found = np.full(count, n, np.uint64)
    for k in range(n):
        found = mixed(found + words[k : k + count])
    return found
