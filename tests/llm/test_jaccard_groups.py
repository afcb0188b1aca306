"""The join of n-gram sets against all pairs compared in plain Python."""

import random
import re

import pytest

from daybook.llm import jaccard_groups
from tests.llm import inputs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(4, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for n, r in enumerate(rows):
        if r[0] is not None:
            least[find(n)] = min(least.get(find(n), r[0]), r[0])
    return sorted([(r[0], len(s), least.get(find(n))) for n, (r, s) in enumerate(zip(rows, sets))], key=repr)


def variants(seed, n_words, count, most_changes):
    """Copies of a text with up to so many words changed, from which links near the threshold come."""
    pick, words = random.Random(seed), inputs.prose(seed, n_words).split()
    for _ in range(count):
        mine = list(words)
        for at in pick.sample(range(n_words), pick.randint(0, most_changes)):
            mine[at] = f"w{pick.randint(0, 10**6)}"
        yield " ".join(mine)


def corpus():
    rows = inputs.edge_rows()
    texts = [t for n in range(6) for t in variants(n, [9, 12, 30, 80, 150, 300][n], 40, [1, 1, 3, 8, 10, 25][n])]
    passage = inputs.prose(77, 50)
    texts += [inputs.prose(500 + n, 4 + n) + " " + passage for n in range(60)]  # mostly one passage, then less
    texts += ["a b c", "a b c d", "a b c d e", "A B C D E f", "a b c d e f g h i j", "a b c d e f g h i"]
    return rows + [inputs.row(100 + n, t) for n, t in enumerate(random.Random(1).sample(texts, len(texts)))]


def test_equals_all_pairs(spark):
    rows = corpus()
    docs = inputs.clashing(inputs.documents(spark, rows), "set", "n", "token", "component_id")
    assert inputs.bag(jaccard_groups.groups(docs.repartition(4))) == brute(rows)


@pytest.mark.parametrize("percent", [60, 95])
def test_other_thresholds_and_small_bounds(spark, monkeypatch, percent):
    for name, value in (("TOKENS_COUNTED", 300), ("MOST_SEEN", 5), ("MOST_HOT", 64), ("LEAST_HOT", 2), ("MOST_BROADCAST", 0), ("TOKENS_OF_COMMON", 5)):
        monkeypatch.setattr(jaccard_groups, name, value)
    rows = corpus()
    docs = inputs.documents(spark, rows).repartition(3)
    assert inputs.bag(jaccard_groups.groups(docs, percent=percent)) == brute(rows, percent)


def test_groups_are_opened_for_what_the_ties_miss(spark, monkeypatch):
    """With ties that connect nothing, every link comes through the matrix of tokens and groups."""
    rows = corpus()
    docs = inputs.documents(spark, rows).repartition(3)
    monkeypatch.setattr(jaccard_groups, "ties", lambda named, percent: named.limit(0).selectExpr("`set` u", "n v"))
    assert inputs.bag(jaccard_groups.groups(docs)) == brute(rows)


def test_empty_table(spark, empty):
    with pytest.raises(ValueError):
        jaccard_groups.groups(empty, percent=50)
    assert jaccard_groups.groups(empty).count() == 0


def test_head_meets_every_set_that_reaches_the_threshold():
    import numpy as np

    pick = random.Random(2)
    for _ in range(300):
        base = pick.sample(range(500), pick.randint(6, 150))
        other = list(base)
        for _ in range(pick.randint(0, 6)):
            other[pick.randrange(len(other))] = pick.randrange(500, 900)
        a, b = (np.unique(np.array(x, np.int64)) for x in (base, other))
        hot = np.unique(np.array(pick.sample(range(900), 40), np.int64))
        power = np.array([pick.randint(3, 9) for _ in hot], np.uint8)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared) and min(len(a), len(b)) >= jaccard_groups.least_size():
            heads = (jaccard_groups.head(s, hot, power)[0] for s in (a, b))
            assert len(np.intersect1d(*heads)) >= jaccard_groups.common(min(len(a), len(b)))
