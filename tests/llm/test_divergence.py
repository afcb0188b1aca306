"""Source divergence against term-by-term arithmetic in plain Python."""

import collections
import random
import re

import numpy as np
import pytest

from daybook.llm import divergence
from tests.llm import inputs

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least_docs, best):
    groups, langs, docs = {}, collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang, source, _ in rows:
        words = TERM.findall(lowered(text or ""))
        groups.setdefault((lang or "", source or ""), collections.Counter()).update(words)
        langs[lang or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for (lang, source), mine in groups.items():
        kept = [w for w, n in docs[lang].items() if n >= least_docs]

        def share(count):
            total = sum(count[w] for w in kept) + 2 * len(kept)
            return {w: 1_000_000_000 * (count[w] + 2) // total + 1 for w in kept}

        p, of_lang = share(mine), share(langs[lang])
        pairs = []
        for (l, other), theirs in groups.items():
            if l == lang and other != source:
                q = share(theirs)
                pairs.append((other, sum((p[w] - q[w]) ** 2 // (p[w] + q[w]) for w in kept)))
        terms = [(w, (p[w] - of_lang[w]) ** 2 // (p[w] + of_lang[w])) for w in kept if mine[w] and p[w] > of_lang[w]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            found = found if part == "pair" else found[:best]
            out += [(lang, source, part, item, value, n) for n, (item, value) in enumerate(found, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_docs", [2, 1000])
def test_equals_brute_force(spark, least_docs):
    pick = random.Random(5)
    rows = inputs.edge_rows() + [
        inputs.row(100 + n, inputs.prose(n % 23, pick.randint(1, 80)), pick.choice("aaab") + pick.choice(["", "é"]),
                   pick.choice(["en", "en", "fr", None]))
        for n in range(150)
    ] + [inputs.row(400, "Aé Ünï aé x x-y z_w 9a", "c", "xx")] * 3 + [inputs.row(401, None, "only", "zz")]
    docs = inputs.clashing(inputs.documents(spark, rows), "term", "times", "value", "rank")
    assert inputs.bag(divergence.audit(docs.repartition(4), least_docs, 5)) == brute(rows, least_docs, 5)


def test_small_blocks_and_counts_handed_on_early(spark, monkeypatch):
    rows = [inputs.row(n, inputs.prose(n % 9, 60), "ab"[n % 2] + str(n % 5)) for n in range(60)]
    docs = inputs.documents(spark, rows).repartition(2)
    want = brute(rows, 3, 4)
    monkeypatch.setattr(divergence, "TERMS_OF_BLOCK", 16)
    monkeypatch.setattr(divergence, "MOST_HELD", 50)
    monkeypatch.setattr(divergence, "MOST_COLUMNS", 8)
    assert inputs.bag(divergence.audit(docs, 3, 4)) == want


def test_empty_table(spark, empty):
    assert divergence.audit(empty).count() == 0


def test_products_equal_sums_over_terms(monkeypatch):
    pick = np.random.default_rng(3)
    for columns in (5, 40, 1024):
        monkeypatch.setattr(divergence, "MOST_COLUMNS", columns)
        p = np.where(pick.random((70, 6)) < 0.6, 5, pick.integers(1, 10**9, (70, 6)))
        got = divergence.divergences(p)
        for g in range(6):
            for h in range(6):
                assert got[g, h] == sum((int(x) - int(y)) ** 2 // (int(x) + int(y)) for x, y in zip(p[:, g], p[:, h]))


def test_counts_beyond_a_long_product():
    big = np.array([10**17, 3, 0], np.int64)
    total = 10**17 + 3 + 6
    assert divergence.shares(big, total).tolist() == [10**9 * (int(c) + 2) // total + 1 for c in big]
