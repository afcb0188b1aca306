import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm import lm_scoring, lm_tables
from tests.llm import inputs
from tests.llm.test_scores_and_mix import plain_scores


@pytest.mark.parametrize("order, small", [(1, False), (2, False), (2, True), (3, True)])
def test_scores_equal_brute_force(spark, edge, monkeypatch, order, small):
    if small:
        monkeypatch.setattr(lm_tables, "PART_BYTES", 3000)
    docs = inputs.clashing(edge, "of", "gram", "times", "units", "score")
    found = inputs.bag(lm_tables.score(docs, order=order))
    expected = plain_scores([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()], order)
    key = lambda r: repr(r[:3])
    assert [r[:3] for r in sorted(found, key=key)] == [r[:3] for r in sorted(expected, key=key)]
    plain = defaultdict(list)
    for r in expected:
        plain[r[:3]].append(r[3])
    for r in found:
        assert min(abs(r[3] / 1e6 - s) for s in plain[r[:3]]) <= 1e-5 * max(1, r[1])
        assert r[4] == (r[3] / r[1] / 1e6 if r[1] else 0.0)


@pytest.mark.parametrize("order, least", [(3, 1), (3, 4), (4, 2), (5, 3)])
def test_longer_orders_equal_brute_force(spark, monkeypatch, order, least):
    """N-grams that cannot occur often enough are not exploded, which changes no score."""
    monkeypatch.setattr(lm_tables, "PART_BYTES", 500)
    pick = random.Random(order)
    rows = [(n, " ".join(pick.choices("abcdefg", k=pick.randint(0, 40)))) for n in range(60)]
    docs = inputs.documents(spark, [inputs.row(*r) for r in rows])
    found = sorted(lm_tables.score(docs, order=order, least_count=least).collect())
    for r, expected in zip(found, sorted(plain_scores(rows, order, least=least)), strict=True):
        assert (r.doc_id, r.n_words, r.n_unseen) == expected[:3]
        assert abs(r.score_units / 1e6 - expected[3]) <= 1e-5 * max(1, r.n_words)


def test_equal_rows_each_count_and_score_alike(spark, monkeypatch):
    monkeypatch.setattr(lm_tables, "PART_BYTES", 300)
    monkeypatch.setattr(lm_tables, "LAID_AT_ONCE", 70)
    rows = [(1, "a b c a b"), (2, "b c d")] * 300 + [(None, "a b c a b")] * 200 + [(3, None), (4, " ")]
    docs = inputs.documents(spark, [inputs.row(*r) for r in rows]).repartition(5)
    found, plain = inputs.bag(lm_tables.score(docs, order=3)), plain_scores(rows, 3)
    assert len(found) == len(rows)
    for r, expected in zip(found, plain, strict=True):
        assert r[:3] == expected[:3] and abs(r[3] / 1e6 - expected[3]) <= 1e-4


def test_many_equal_rows_are_looked_at_once(spark):
    text = inputs.prose(1, 30)
    docs = spark.range(0, 100_000, 1, 8).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    assert [(r.doc_id, r.copies) for r in lm_tables._dealt(docs).collect()] == [(7, 100_000)]
    found = lm_tables.score(docs).groupBy("doc_id", "n_words", "n_unseen", "score_units").count().collect()
    plain = plain_scores([(7, text)] * 50, 2)[0]
    assert [(r.doc_id, r.n_words, r.n_unseen, r["count"]) for r in found] == [(7, 30, 0, 100_000)]
    assert abs(found[0].score_units / 1e6 - plain[3]) <= 1e-3


def test_a_frequent_gram_is_one_row_a_part(spark, monkeypatch):
    monkeypatch.setattr(lm_tables, "PART_BYTES", 2000)
    docs = inputs.documents(spark, [inputs.row(n, "same pair " * 50 + str(n)) for n in range(40)])
    rows = lm_tables._dealt(docs)
    parts = rows.select("part").distinct().count()
    exploded = rows.groupBy("part").applyInArrow(
        lambda key, table: lm_tables._Part(table, 2, 2).exploded(key[0].as_py(), 0), lm_tables._GRAMS
    )
    assert parts > 4 and exploded.groupBy("gram").count().agg(F.max("count")).first()[0] == parts


def test_both_forms_score_alike(spark, monkeypatch):
    monkeypatch.setattr(lm_tables, "PART_BYTES", 700)
    pick = random.Random(9)
    rows = [(n, " ".join(pick.choices("abcdefghij", k=pick.randint(0, 60)))) for n in range(80)]
    docs = inputs.documents(spark, [inputs.row(*r) for r in rows])
    assert inputs.bag(lm_tables.score(docs, order=3)) == inputs.bag(lm_scoring.score(docs, order=3))


def test_empty_table(empty):
    assert lm_tables.score(empty).collect() == []
