import random

import numpy as np
import pytest
import xxhash

from daybook.llm import simhash
from daybook.llm.components import components
from daybook.llm.words import pieces
from tests.llm import inputs


def plain_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = inputs.WORD.findall(lowered)
    runs = [words[k : k + size] for k in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, near):
    """Component number of each node by plain search."""
    seen = {}
    for n in nodes:
        if n not in seen:
            seen[n], todo = n, [n]
            while todo:
                at = todo.pop()
                for other in nodes:
                    if other not in seen and near(at, other):
                        seen[other] = n
                        todo.append(other)
    return seen


def plain_groups(df):
    """(doc_id, fingerprint) of every row, each fingerprint's group, and each group's least doc_id."""
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]
    roots = classes(sorted({fp for _, fp in rows}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = dict.fromkeys(roots.values())
    for doc_id, fp in rows:
        if doc_id is not None:
            least[roots[fp]] = min(doc_id, least[roots[fp]] or doc_id)
    return rows, roots, least


def test_edge_rows_equal_brute_force(edge):
    rows, roots, least = plain_groups(edge)
    expected = sorted(((i, f"{fp:016x}", least[roots[fp]]) for i, fp in rows), key=repr)
    assert inputs.bag(simhash.groups(edge)) == expected


@pytest.mark.parametrize("large", [4096, 3])
def test_links_tie_every_pair_within_the_radius(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)  # 3: most buckets are covered twice
    pick = random.Random(7)
    prints = set()
    for _ in range(40):
        at = pick.getrandbits(64)
        for _ in range(12):  # a walk whose steps are within the radius, or one bit beyond
            prints.add(at)
            for bit in pick.sample(range(64), pick.randint(1, 4)):
                at ^= 1 << bit
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), 3).collect()
    linked = {(r.u % (1 << 64), r.v % (1 << 64)) for r in links}
    assert all((u ^ v).bit_count() <= 3 for u, v in linked)
    around = {p: set() for p in prints}
    for u, v in linked:
        around[u].add(v)
        around[v].add(u)
    nodes = sorted(prints)
    expected = classes(nodes, lambda a, b: (a ^ b).bit_count() <= 3)
    assert classes(nodes, lambda a, b: b in around[a]) == expected
    assert len(set(expected.values())) > 40


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_some_mask_misses_any_few_bits(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    pick = random.Random(radius)
    for _ in range(2000):
        change = sum(1 << b for b in pick.sample(range(64), radius))
        assert any(change & mask == 0 for mask in masks)
    assert all(mask.bit_count() >= 24 for mask in masks)


def test_a_dense_bucket_gives_a_tree_and_not_all_pairs():
    prints = np.arange(256, dtype=np.uint64)
    links = list(simhash._spanning(prints, 3))
    assert len(links) == 255


@pytest.mark.parametrize("size", [1, 3])
def test_long_texts_are_read_whole(monkeypatch, size):
    text = inputs.prose(3, 3000)
    whole = simhash.fingerprint(text.encode(), size)
    assert whole == plain_fingerprint(text, size)
    monkeypatch.setattr(pieces, "__defaults__", (97,))
    assert simhash.fingerprint(text.encode(), size) == whole


def test_one_row_of_each_group_stays(edge):
    kept = simhash.representatives(inputs.clashing(edge, "missing", "id", "text_key", "row"))
    assert kept.columns == [*edge.columns, "missing", "id", "text_key", "row"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(plain_groups(edge)[2].values(), key=repr)


def test_empty_table(empty):
    assert simhash.groups(empty).collect() == []
    assert simhash.representatives(empty).columns == empty.columns


def test_components_of_chains_stars_and_loops(spark):
    chain = [(n, n + 1) for n in range(0, 200)]
    star = [(1000, n) for n in range(1001, 1100)]
    links = chain + star + [(-5, -5), (-7, 3000), (3000, -7), (3000, 4000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    expected = {n: 0 for n in range(201)} | {n: 1000 for n in range(1000, 1100)} | {-7: -7, 3000: -7, 4000: -7}
    assert found == expected
