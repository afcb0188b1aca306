"""Secret scans with structural confirmation.

Three plain patterns find assignments, access keys and long hex runs. Beyond them, base64 and hex
runs are decoded and reported only if what they hold is built like a key or a signed token: nested
lengths that add up, a key encoding that parses, or a token header that names its algorithm. What
separates the pieces of a key is taken out first: escaped line breaks, quotes and operators of source
code, marks of quoted mail, colons between bytes. Spans cover it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# The plain patterns and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ["assign", "access", "hex", "der", "pem", "ssh", "token"]
RANK = {kind: n for n, kind in enumerate(KINDS)}

# Parts joined by dots, neither led by another part nor followed by one; a dot that ends a sentence may follow.
_PART = "[A-Za-z0-9_-]"
_OPENS, _CLOSES = rf"(?<!{_PART})(?<!{_PART}\.)", rf"(?!\.{_PART})"
TOKEN = re.compile(rf"{_OPENS}({_PART}{{8,}}+)\.({_PART}{{2,}}+)\.({_PART}{{8,}}+){_CLOSES}")
SEALED = re.compile(
    rf"{_OPENS}({_PART}{{8,}}+)\.({_PART}*+)\.({_PART}{{8,}}+)\.({_PART}++)\.({_PART}{{8,}}+){_CLOSES}"
)
# Armoured keys, also as they stand in quoted mail, comments, and strings of source code or JSON.
PEM = re.compile(r"""-----BEGIN ([A-Z0-9 ]*KEY)-----([A-Za-z0-9+/=\s\\"'>|*\#,;.&()]++)-----END \1-----""")
ESCAPED = re.compile(r"(?<!\\)\\++u00(2[bBfF]|3[dD])")  # + / = as some writers of JSON put them
JOINED = re.compile(r"""(?<!\\)\\*+["']\s*+[+.,&]?\s*+\\*+["']|(?<!\\)\\++[nrt]|[^A-Za-z0-9+/=]""")
# Runs of either alphabet, and what may stand between something glued before a key and the key.
RUN64 = ((re.compile(r"[A-Za-z0-9+/]{40,}={0,2}"), "/"), (re.compile(r"[A-Za-z0-9_-]{40,}={0,2}"), "-_"))
LEAST_RUN, HEAD = 40, 96  # characters; the head holds the longest name of an SSH key type
# Runs that end their line and go on in the next one, and the runs of such a block.
WRAPPED64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+={0,2}"
)
LINE64 = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
RUN16 = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
# Bytes in hex with something between them: colons, spaces, line breaks, prefixes; a key begins with 30.
_BETWEEN = r"(?:[:,\s>-]{1,16}+(?:0x|\\x)?|\\x)"
PAIRS16 = re.compile(rf"(?<![0-9A-Za-z])(?:0x|\\x)?30(?:{_BETWEEN}?[0-9A-Fa-f]{{2}}){{31,}}+")
PAIR16 = re.compile(rf"(?:{_BETWEEN}|0x)?([0-9A-Fa-f]{{2}})")
SSH_TYPES = re.compile(rb"(ssh-|ecdsa-|sk-)[a-z0-9@.-]+")
OPENSSH = b"openssh-key-v1\0"

_HEX_BYTES = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_RUN_BYTES = bytes(
    104 if chr(i) in "+/_=.-" or (i < 128 and chr(i).isalnum()) else 32 for i in range(256)
)
_LONG_HEX, _LONG_RUN = b"h" * LEAST["hex"], b"h" * 20


def base_spans(text: str, raw: bytes) -> Iterator[tuple[int, int, str]]:
    low = raw.lower()
    if any(word in low for word in (b"passw", b"secret", b"token", b"api")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                yield m.start(), m.end(), "assign"
    if b"AKIA" in raw:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                yield m.start(), m.end(), "access"
    if _LONG_HEX in raw.translate(_HEX_BYTES):
        for m in HEX.finditer(text):
            if m.end() - m.start() >= LEAST["hex"]:
                yield m.start(), m.end(), "hex"


def decoded64(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the content of the element at ``at``, or None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 0 < n <= 4 or start + n > end:
            return None
        size, start = int.from_bytes(data[start : start + n], "big"), start + n
    return (tag, start, start + size) if start + size <= end else None


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the data, whose elements fill it, with an integer, key or curve inside.

    Fits the public encodings of RSA, EC and wrapped private keys and of wrapped public keys: a
    version or modulus, or an algorithm (a sequence that starts with an object identifier) and a
    string that holds the key.
    """
    outer = der_element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    tags, at, algorithm = [], outer[1], False
    while at < outer[2]:
        inner = der_element(data, at, outer[2])
        if inner is None:
            return False
        if inner[0] == 0x30:
            first = der_element(data, inner[1], inner[2])
            algorithm = algorithm or (first is not None and first[0] == 0x06)
        tags.append(inner[0])
        at = inner[2]
    rsa = len(tags) >= 2 and all(tag == 0x02 for tag in tags) and len(data) >= 60
    wrapped = algorithm and any(tag in (0x03, 0x04) for tag in tags)
    curve = tags[:2] == [0x02, 0x04]
    return rsa or wrapped or curve


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first of which names a key type."""
    if data.startswith(OPENSSH):
        return True
    at, fields = 0, 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        field = data[at + 4 : at + 4 + size]
        if len(field) < size or fields == 0 and not SSH_TYPES.fullmatch(field):
            return False
        at, fields = at + 4 + size, fields + 1
    return at == len(data) and fields >= 2


def is_token(header: str, body: str) -> bool:
    """A header that decodes to an object with an algorithm, and a body that decodes to an object.

    Encrypted tokens, whose body is no object, need a type or key id beside the algorithm.
    """
    try:
        head = json.loads(decoded64(header) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(head.get("alg"), str):
        return False
    try:
        return isinstance(json.loads(decoded64(body) or b""), dict) or "typ" in head or "kid" in head
    except (ValueError, RecursionError):
        return "typ" in head or "kid" in head


class Covered:
    """Whether a span lies inside one of those given."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.spans = sorted(spans)
        self.starts = [a for a, _, _ in self.spans]
        self.reach = list(accumulate((b for _, b, _ in self.spans), max))

    def __contains__(self, span: tuple[int, int, str]) -> bool:
        at = bisect_right(self.starts, span[0])
        return at > 0 and self.reach[at - 1] >= span[1]


def is_sealed(header: str, *parts: str) -> bool:
    """Five parts of base64, a header that names an algorithm and an encryption first."""
    try:
        head = json.loads(decoded64(header) or b"")
    except (ValueError, RecursionError):
        return False
    named = isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(head.get("enc"), str)
    return named and all(decoded64(part) is not None for part in parts)


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def may_start(run: str, at: int, end: int) -> bool:
    """Whether the head of what is left of a run, up to its padding, fits a key that fills it."""
    left = end - at
    head = decoded64(run[at : at + min(HEAD, left)])
    if head is None:  # what is left has no whole number of bytes
        return False
    outer = der_element(head, 0, left * 3 // 4)
    if outer is not None and outer[0] == 0x30 and outer[2] == left * 3 // 4:
        return True
    size = int.from_bytes(head[:4], "big")
    return head.startswith(OPENSSH) or bool(SSH_TYPES.fullmatch(head[4 : 4 + size]))


def run_spans(run: str, glue: str) -> Iterator[tuple[int, int, str]]:
    """The key that a run ends with: the whole run, or what follows one of the characters of ``glue``."""
    if kind := key_kind(decoded64(run)):
        yield 0, len(run), kind
        return
    end = len(run.rstrip("="))
    for m in re.finditer(f"[{glue}]", run):
        if len(run) - m.end() < LEAST_RUN:
            return
        if may_start(run, m.end(), end) and (kind := key_kind(decoded64(run[m.end() :]))):
            yield m.end(), len(run), kind
            return


def wrapped_spans(block: str) -> Iterator[tuple[int, int, str]]:
    """Keys in lines of equal length, which a line with something before it may lead and a shorter one end."""
    lines = list(LINE64.finditer(block))
    sizes, at = [len(m[0]) for m in lines], 0
    while at < len(lines):
        last = at
        while last + 1 < len(lines) and sizes[last + 1] == sizes[at]:
            last += 1
        tails = [last + 1, last] if last + 1 < len(lines) and sizes[last + 1] < sizes[at] + 2 else [last]
        for a, b in ((a, b) for a in (at, at - 1) for b in tails if a >= 0 and b > a):
            run = "".join(m[0] for m in lines[a : b + 1])
            mixed = any(c in run for c in "+/") and any(c in run for c in "-_")
            if not mixed and len(run) >= LEAST_RUN and (kind := key_kind(decoded64(run))):
                yield lines[a].start(), lines[b].end(), kind
                break
        at = last + 1


def unarmoured(body: str) -> str:
    """The base64 of an armoured key without quotes, operators, escapes and marks of quoted lines."""
    return JOINED.sub("", ESCAPED.sub(lambda m: chr(int(m[1], 16)), body))


def paired_span(run: str) -> tuple[int, int, str] | None:
    """The key that bytes in hex begin with; after its last byte the run must end or have white space."""
    pairs = list(PAIR16.finditer(run))
    data = bytes.fromhex("".join(m[1] for m in pairs))
    outer = der_element(data, 0, len(data))
    if outer is None or len(pairs) * 2 == len(run):  # without anything between them they are a plain run
        return None
    n = outer[2]
    ends = n == len(pairs) or any(c.isspace() for c in run[pairs[n].start() : pairs[n].start(1)])
    return (0, pairs[n - 1].end(), "der") if ends and is_der_key(data[:n]) else None


def confirmed_spans(text: str, raw: bytes) -> Iterator[tuple[int, int, str]]:
    """Spans of candidates whose structure is confirmed."""
    found: list[tuple[int, int, str]] = []
    if b"-----BEGIN " in raw:
        for m in PEM.finditer(text):
            data = decoded64(unarmoured(m[2]))
            if data and (is_der_key(data) or is_ssh_key(data)):
                found.append((m.start(), m.end(), "pem"))
    for m in PAIRS16.finditer(text):
        if span := paired_span(m[0]):
            found.append((m.start() + span[0], m.start() + span[1], span[2]))
    if _LONG_RUN not in raw.translate(_RUN_BYTES):
        yield from found
        return
    for m in TOKEN.finditer(text):
        if is_token(m[1], m[2]):
            yield m.start(), m.end(), "token"
    for m in SEALED.finditer(text):
        if is_sealed(*m.groups()):
            yield m.start(), m.end(), "token"
    keys: list[tuple[int, int, str]] = []
    known = Covered(keys)
    for pattern, glue in RUN64:
        for m in pattern.finditer(text):
            spans = [(m.start() + a, m.start() + b, kind) for a, b, kind in run_spans(m[0], glue)]
            keys += [s for s in spans if s not in known]
        known = Covered(keys)
    known = Covered(found + keys)
    for m in WRAPPED64.finditer(text):
        spans = [(m.start() + a, m.start() + b, kind) for a, b, kind in wrapped_spans(m[0])]
        keys += [s for s in spans if s not in known]
    yield from {*found, *keys}
    for m in RUN16.finditer(text):
        if kind := key_kind(bytes.fromhex(m[0])):
            yield m.start(), m.end(), kind


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text in code points, end exclusive, by start and kind."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = {*base_spans(text or "", raw), *confirmed_spans(text or "", raw)}
    return sorted(found, key=lambda s: (s[0], RANK[s[2]], s[1]))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [
            [{"start": a, "end": b, "kind": k} for a, b, k in spans_of(text.as_py())]
            for text in batch.column("text")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(spans, SPANS)], ["doc_id", "spans"]
        )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, end, kind) for every row, in one pass without a shuffle.

    A null text counts as empty and has no spans. Equal rows give equal rows. Long texts are read
    whole; spans are found in time linear in the text, since no pattern can start again inside a run
    it has read, but for runs with many places whose head claims exactly what is left of the run. Other columns of ``docs`` are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan, "doc_id bigint, spans array<struct<start:bigint,end:bigint,kind:string>>"
    )
