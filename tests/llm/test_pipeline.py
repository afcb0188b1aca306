"""The pipeline against plain versions of its stages, on small tables."""

import hashlib
import math
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from daybook.llm import compression_quality, sharding
from daybook.llm.queries import SHARDS
from tests.llm import inputs
from tests.llm.test_decontaminate import ITEMS, brute
from tests.llm.test_quality import corpus
from tests.llm.test_scores_and_mix import plain_targets
from tests.llm.test_simhash import classes, plain_fingerprint


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    items = [(n, inputs.prose(900 + n, 30)) for n in range(6)]
    rows = [(*r[:3], "abcd"[r[0] % 4] if r[0] % 11 else None, r[4]) for r in rows]
    rows += [inputs.row(1000 + n, rows[3 * n + 1][1], "b") for n in range(20)]  # copies of good rows
    rows += [inputs.row(2000 + n, inputs.prose(n, 40) + " " + items[n % 6][1] + " " + inputs.prose(70 + n, 20), "c") for n in range(15)]
    rows += inputs.edge_rows()
    rows = [r for n, r in enumerate(rows) if r[0] is None or r[0] not in {q[0] for q in rows[:n]}]  # one row per doc_id
    inputs.documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, inputs.LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def plain_pipeline(rows, items, model):
    pair = model.compressors()
    raw = lambda r: (r[1] or "").encode()
    good = [r for r in rows if model.score(compression_quality.difference(raw(r), *pair)) >= compression_quality.THRESHOLD]

    prints = {r: plain_fingerprint(r[1]) for r in good}
    roots = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for r in sorted(good, key=lambda r: math.inf if r[0] is None else r[0]):
        first.setdefault(roots[prints[r]], r)
    unique = list(first.values())

    marks = {}
    for doc, r in zip(brute([(n, r[1]) for n, r in enumerate(unique)], items), range(len(unique))):
        marks[doc[0]] = doc[2]
    clean = [r for n, r in enumerate(unique) if marks[n] == 0]

    sizes = Counter()
    for r in clean:
        sizes[r[3]] += len(inputs.WORD.findall(r[1] or ""))
    targets = plain_targets(dict(sizes))
    mixed = []
    for r in clean:
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0.0
        key = ":".join(["1", "-" if r[0] is None else str(r[0]), *([] if r[1] is None else [r[1]])])
        coin = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13
        mixed += [r] * (math.floor(rate) + (coin < rate - math.floor(rate)))

    owners = sharding.lookup_table(SHARDS)
    out = []
    for r in mixed:
        key = (r[1] or "").encode() if r[0] is None else r[0].to_bytes(8, "little", signed=True)
        h = 42 if r[0] is None and r[1] is None else xxhash.xxh64_intdigest(key, 42)
        slot = (h - (1 << 64) if h >> 63 else h) % sharding.SLOTS
        out.append((*r, slot, SHARDS[owners[slot]]))
    return good, unique, clean, mixed, out


def test_run_equals_the_plain_stages(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = compression_quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good, unique, clean, mixed, out = plain_pipeline(rows, items, model)
    assert len(rows) > len(good) > len(unique) > len(clean) > 50 and len(set(mixed)) < len(mixed)
    assert inputs.bag(corpus_pipeline.run(spark, folder)) == sorted(out, key=repr)


def test_stages_return_the_columns_of_their_input(spark, tables, empty):
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = inputs.clashing(docs, "row", "score", "id", "fp", "words", "rate", "copies", "slot")
    for frame in (extra, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, frame, folder)
            assert kept.columns == frame.columns
            assert kept.count() <= 3 * frame.count()
        last = corpus_pipeline.STAGES[-1][1](spark, frame, folder)
        assert [c for c in last.columns if c not in ("slot", "shard")] == [c for c in frame.columns if c != "slot"]
        assert last.count() == frame.count()


def test_stages_come_in_the_agreed_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights", "sharding",
    ]
