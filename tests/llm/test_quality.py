import math
import random
import zlib

import numpy as np
import pytest
import zstandard

from daybook.llm import compression_quality, labelled, quality_rules
from daybook.llm.words import pieces, word_hashes
from pyspark.sql import functions as F
from tests.llm import inputs


def corpus():
    """Good prose, and bad rows of four kinds: shouting, symbols, menus, one word over and over."""
    rows, labels = [], []
    for n in range(240):
        text = inputs.prose(1000 + n, 60 + n % 90)
        words = text.split()
        good = n % 3 > 0
        if not good:
            text = [
                " ".join(w.upper() + "!!" for w in words), " ".join(w + "###" for w in words),
                " | ".join(w.title() for w in words[::3]), " ".join(w for w in words[:5] for _ in range(20)),
            ][n // 3 % 4]
        rows.append(inputs.row(n, text))
        labels.append((n, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = corpus()
    return inputs.documents(spark, rows).cache(), spark.createDataFrame(labels, inputs.LABELS).cache()


def accuracy(judged, labels, verdict):
    rows = judged.join(labels, "doc_id").filter(labelled.held_out(F.col("doc_id")))
    right, total = rows.agg(F.sum((verdict.cast("int") == F.col("quality")).cast("int")), F.count("*")).first()
    assert total > 30
    return right / total


def test_held_out_is_the_remainder_of_crc32(spark):
    found = spark.range(300).select("id", labelled.held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in found] == [zlib.crc32(str(r.id).encode()) % 5 == 0 for r in found]


def test_compression_tells_held_out_rows_apart(data):
    docs, labels = data
    scored = compression_quality.score(docs, compression_quality.train(docs, labels))
    assert accuracy(scored, labels, F.col("score") >= compression_quality.THRESHOLD) > 0.9


def test_compression_scores_equal_plain_compression(data, edge):
    """Every 256 bytes of a text on their own, with a new compressor for each, in plain Python."""
    docs, labels = data
    model = compression_quality.train(docs, labels)

    def size(piece, dictionary):
        trained = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=False).compress(piece))

    def plain(text):
        raw, saved = (text or "").encode(), 0
        while raw:
            piece, raw = raw[:256], raw[256:]
            saved += size(piece, model.bad) - size(piece, model.good)
        line = model.slope * (saved + 2) / (len((text or "").encode()) + 50) + model.intercept
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, line))))

    rows = docs.filter("doc_id % 7 = 0").unionByName(edge.filter("coalesce(n_chars, 0) < 10000"))
    found = compression_quality.score(rows.withColumn("doc_id", F.struct("doc_id", "text")), model).collect()
    assert len(found) == rows.count()
    for r in found:
        assert r.score == pytest.approx(plain(r.doc_id.text), abs=1e-12)


def test_hashed_ngrams_tell_held_out_rows_apart(data):
    docs, labels = data
    judged = quality_rules.judge(docs, quality_rules.train(docs, labels))
    assert accuracy(judged, labels, F.col("kept")) > 0.9


def test_held_out_labels_and_other_columns_do_not_matter(data):
    docs, labels = data
    turned = labels.withColumn(
        "quality", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id").cast("string"))
    for module, apply in ((compression_quality, compression_quality.score), (quality_rules, quality_rules.judge)):
        first = inputs.bag(apply(docs, module.train(docs, labels)))
        assert inputs.bag(apply(other, module.train(other, turned.repartition(5)))) == first


def test_edge_rows_have_a_score(spark, data, edge, empty):
    docs, labels = data
    model, rules = compression_quality.train(docs, labels), quality_rules.train(docs, labels)
    both = inputs.clashing(edge, "score", "row", "kept", "probability")
    scores = inputs.bag(compression_quality.score(both, model))
    assert len(scores) == edge.count() and all(0 <= s <= 1 for _, s in scores)
    assert dict(scores)[1] == dict(scores)[2]  # null as empty
    assert len(inputs.bag(quality_rules.judge(both, rules))) == edge.count()
    kept = compression_quality.keep(both, model)
    assert kept.columns == both.columns
    assert kept.count() == sum(s >= compression_quality.THRESHOLD for _, s in scores)
    assert compression_quality.score(empty, model).collect() == quality_rules.judge(empty, rules).collect() == []


def test_without_usable_labels_all_rows_score_alike(spark, edge, empty):
    broken = [(None, 1, 0), (5, None, 0), (5, 7, 0), (99, 0, 0)]
    for rows in ([], broken):
        labels = spark.createDataFrame(rows, inputs.LABELS)
        assert len({s for _, s in inputs.bag(compression_quality.score(edge, compression_quality.train(edge, labels)))}) == 1
        judged = quality_rules.judge(edge, quality_rules.train(edge, labels)).select("probability").distinct()
        assert judged.count() == 1
    assert compression_quality.train(empty, labels).good == b""


def test_calibration_follows_the_data():
    pick = np.random.default_rng(3)
    labels = (pick.random(4000) < 0.8).astype(int)
    values = pick.normal(labels * 2.0, 1.0)  # log odds 2 x - 2 + log 4
    slope, intercept = labelled.calibrated(values, labels, labels.mean())
    assert abs(slope - 2) < 0.3 and abs(intercept - (np.log(4) - 2)) < 0.3


def plain_counts(text):
    words = inputs.WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n")]
    repeated = sum(1 for n, line in enumerate(lines) if inputs.WORD.search(line) and line in lines[:n])
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen = {}
    for k, w in enumerate(windows):
        seen.setdefault(w, []).append(k)
    covered = {k + d for at in seen.values() if len(at) > 1 for k in at for d in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def test_plain_counts_equal_brute_force(spark, data):
    pick = random.Random(1)
    texts = [None, "", "# | <a> \t\n\n", "x\x0by\x0cz\x1cw\x85v", "é" * 9]
    for n in range(40):
        lines = [inputs.prose(pick.randint(0, 5), pick.randint(0, 12)) for _ in range(pick.randint(1, 9))]
        texts.append(pick.choice(["\n", "\n \n", " "]).join(lines))
    df = inputs.documents(spark, [inputs.row(n, t) for n, t in enumerate(texts)])
    rules = quality_rules.train(*data)
    found = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_rules.judge(df, rules).collect()
    }
    assert found == {n: plain_counts(t) for n, t in enumerate(texts)}


def test_pieces_are_cut_at_white_space():
    raw = inputs.prose(9, 500).encode()
    assert b"".join(pieces(raw, 64)) == raw and len(list(pieces(raw, 64))) > 10
    assert [w for p in pieces(raw, 64) for w in p.split()] == raw.split()
    assert len(word_hashes(raw)) == len(raw.split())


def test_scores_do_not_depend_on_pieces(data, monkeypatch):
    docs, labels = data
    model = quality_rules.train(docs, labels)
    raw = inputs.prose(9, 900).encode()
    whole = model.margin(raw, word_hashes(raw))
    share = quality_rules.features(raw) @ model.weights + model.bias
    assert abs(whole - share) < 1e-9


def test_chunks_of_a_text_that_a_dictionary_sees():
    """Few chunks train nothing, so the dictionary is the chunks themselves."""
    text = b"".join(bytes([97 + n]) * compression_quality.CHUNK for n in range(6))
    seen = {m: compression_quality.build_dictionary([text], m) for m in (2, 3, None)}
    assert seen == {2: b"a" * 256 + b"d" * 256, 3: b"a" * 256 + b"c" * 256 + b"e" * 256, None: text}


def test_train_takes_the_chunks_of_a_text(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(compression_quality, "build_dictionary", lambda texts, most: asked.append(most) or b"")
    docs = inputs.documents(spark, [inputs.row(1, "some text")])
    labels = spark.createDataFrame([(1, 1, 0)], inputs.LABELS)
    compression_quality.train(docs, labels, chunks_of_text=None)
    compression_quality.train(docs, labels)
    assert asked == [None, None, 32, 32]
