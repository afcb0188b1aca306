"""Small inputs for the operators of the subpackage, with the rows that are easily forgotten."""

from __future__ import annotations

import random
import re

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
SYLLABLES = ["an", "be", "co", "dé", "en", "fü", "go", "hi", "ir", "jo", "ka", "lu", "mo", "ñe", "or", "pa"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n_words):
    pick = random.Random(seed)
    words = ["".join(pick.choices(SYLLABLES, k=pick.randint(1, 4))) for _ in range(n_words)]
    return "".join(w + ("\n" if n % 17 == 16 else " ") for n, w in enumerate(words)).strip()


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def edge_rows():
    """Nulls, empty and very long texts, copies, near copies, equal rows and rows without doc_id."""
    base, long_text = prose(1, 120), prose(2, 60_000)
    near = base.replace(base.split()[40], "changed")
    return [
        row(5, base), row(3, base, "b"), row(9, base + " " + prose(3, 60), None), row(7, near, "b"),
        row(1, None), row(2, ""), row(4, " \n\t "), row(6, "one"), row(8, "two words", ""),
        row(10, prose(4, 200), "c"), row(10, prose(4, 200), "c"), row(10, prose(5, 80), "c"),
        row(None, prose(6, 90), None), row(None, base), row(None, None, None, None),
        row(11, long_text, "d"), row(12, long_text[300_000:] + " tail", "d"), row(13, "same same same " * 400, "a"),
        row(14, "Ünï\u0000code \U0001F600 " * 30, "é"), row(15, "\x1f\x85   no white space here", "b"),
        (16, prose(7, 50), None, None, None),
    ]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(df, *names):
    """``df`` with extra columns that have the names an operator gives its own."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(f"mine {n}").alias(n) for n in names if n not in df.columns))


def bag(df, *columns):
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=repr)


def shuffled(rows, seed=0):
    return random.Random(seed).sample(rows, len(rows))
