"""Cross-tokenizer alignment against whole texts encoded at once and walked token by token."""

import collections
import hashlib

import numpy as np
import pytest

from daybook.llm import incidence, token_links
from tests.llm import inputs

FOLDER = "/opt/tokenizers"
ODD = [
    "a", "\t", "  ", " \n\n  x", "x \r\n y;\r z", "<|endoftext|> <s> <unk> <0x0A>", "a▁b", "\x00 z\x1c\x1d !\x1c x",
    "　漢字 かな　x", "é\xa0a b\xa0 c", "😀 😀", "  x  ", "a\x85b \x85 c", "x" * 5000, "a\t\n b\t c", "won't  don't'll",
    " " * 50, "\n" * 7, "x\n\n\ny  \n z   ", "᠎ x᠎ y ᠎", "def f(x):\n    return {'a': x};\r\n",
]


@pytest.fixture(scope="module")
def files():
    return token_links.Tokenizers.read(FOLDER)


@pytest.fixture(scope="module")
def encoder(files):
    return token_links.Encoder(files)


def tokens(encoder, text):
    """(ids of A, ids of B) or none, from the whole text."""
    if not text:
        return [], []
    raw = (" " + text).encode()
    a = encoder._a.encode(" " + text, add_special_tokens=False).ids
    b = encoder._b.encode(text)
    same = b"".join(encoder.a_bytes[t] for t in a) == raw == b"".join(encoder.b_bytes[t] for t in b)
    return (a, b) if same else ([], [])


def walked(encoder, text):
    """Groups as (ids of A, ids of B), by taking a token from whichever side is behind."""
    a, b = tokens(encoder, text)
    a, b, groups, x, y, left, right = a[::-1], b[::-1], [], 0, 0, [], []
    while a or b:
        if x <= y:
            left.append(a.pop())
            x += len(encoder.a_bytes[left[-1]])
        else:
            right.append(b.pop())
            y += len(encoder.b_bytes[right[-1]])
        if x == y:
            groups.append((left, right))
            left, right = [], []
    return groups


def brute(encoder, texts):
    """The rows of link_strength without doc_id, in order of the texts."""
    groups = [walked(encoder, t) for t in texts]
    links = [[(g[0][-1], g[1][-1]) for g in of] for of in groups]
    count = collections.Counter(pair for of in links for pair in of)
    highest = collections.defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    rows = []
    for of, linked in zip(groups, links):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in of)
        rows.append((
            sum(len(x) for x, _ in of), sum(len(y) for _, y in of), len(of), len(linked),
            sum(count[p] == highest[p[1]] for p in linked), sum(count[p] for p in linked),
            hashlib.sha256(said.encode()).hexdigest() if of else "",
        ))
    return rows


def test_link_strength_equals_brute_force(spark, files, encoder):
    rows = inputs.edge_rows() + [inputs.row(100 + n, text) for n, text in enumerate(ODD)]
    docs = inputs.documents(spark, rows).repartition(3)
    got = inputs.bag(token_links.link_strength(inputs.clashing(docs, "n_a", "pairs", "row_id"), files))
    want = [(r[0], *w) for r, w in zip(rows, brute(encoder, [r[1] for r in rows]))]
    assert got == sorted(want, key=repr)


def test_empty_table(spark, files, empty):
    assert token_links.link_strength(empty, files).count() == 0
    assert token_links.token_links(empty, files).count() == 0


def test_pieces_and_forgotten_chunks_change_nothing(files, monkeypatch):
    texts = [inputs.prose(1, 3000), inputs.prose(2, 3000), "x " * 4000]
    whole = [token_links.Aligner(files).document(t) for t in texts]
    monkeypatch.setattr(token_links, "PIECE", 500)
    monkeypatch.setattr(token_links, "MOST_HELD", 20_000)
    own = token_links.Aligner(files)
    for text, want in zip(texts, whole):
        got = own.document(text)
        assert got[:4] == want[:4]
        assert got[4].tolist() == want[4].tolist() and got[5].tolist() == want[5].tolist()


def test_token_of_the_second_vocabulary_in_the_text(files, encoder):
    assert token_links.Aligner(files).document("a▁b")[:4] == (0, 0, 0, "")
    assert token_links.Aligner(files).document("<|endoftext|>")[0] > 1  # a special token would be one


@pytest.mark.parametrize("kind", token_links.KINDS)
def test_links_of_every_kind(spark, files, encoder, kind, monkeypatch):
    monkeypatch.setattr(token_links, "MOST_CELLS", 64)
    texts = [inputs.prose(3, 60), "won't  don't", None, "", "a▁b", inputs.prose(4, 5)]
    docs = inputs.documents(spark, [inputs.row(n, t) for n, t in enumerate(texts)])
    want = []
    for n, text in enumerate(texts):
        a, b = tokens(encoder, text or "")
        ends = [np.cumsum([len(size[t]) for t in ids]) for ids, size in ((a, encoder.a_bytes), (b, encoder.b_bytes))]
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        for i, x in enumerate(ends[0]):
            for j, y in enumerate(ends[1]):
                shared = min(x, y) - max(ends[0][i - 1] if i else 0, ends[1][j - 1] if j else 0)
                group = np.searchsorted(cuts, x) == np.searchsorted(cuts, y)
                if {"overlap": shared > 0, "end": x == y, "group": group}[kind]:
                    want.append((n, i, j, a[i], b[j], 1 if kind == "group" else int(shared)))
    assert inputs.bag(token_links.token_links(docs, files, kind)) == sorted(want, key=repr)


def test_product_equals_dense():
    pick = np.random.default_rng(1)
    for _ in range(20):
        x, y = pick.random((7, 9)) < 0.4, pick.random((9, 5)) < 0.4

        def csr(m):
            return incidence.Csr(np.r_[0, np.cumsum(m.sum(1))], np.nonzero(m)[1], m.shape[1])

        for parts in (list(incidence.products(csr(x), csr(y), most)) for most in (1, 6, 1000)):
            dense = np.zeros((7, 5), int)
            for row, column, value in parts:
                dense[row, column] += value
            assert (dense == x.astype(int) @ y.astype(int)).all()
        assert (np.diff(csr(x).transposed().indptr) == x.sum(0)).all()
