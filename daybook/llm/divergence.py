"""How far the sources of a language diverge in their words, by products of one-hot level matrices.

A group is a source of a language. For a block of terms, every (group, count level) is an indicator
column; the columns times their transpose give the joint table of every two groups, how many terms have
one level here and another there. A price depends on the two levels only, so a joint table is priced
once a cell and not once a term. Rare terms share few levels and are many to a product; where levels
abound, blocks of terms are halved, and wide products are taken in blocks of columns. Counts in a
product stay below 2^24, so single precision is exact.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.words import pieces
from daybook.session import materialise

# What a term is made of, in bytes; the scale of shares and what is added to each count.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE, ADDED = 1_000_000_000, 2
LEAST_DOCS, BEST = 10, 10

MOST_HELD = 400_000  # distinct (group, term) that a task counts before it hands them on
TERMS_OF_BLOCK, CELLS_OF_BLOCK = 4096, 1 << 18  # terms, and terms times sources, that one task prices
MOST_COLUMNS = 1024  # of a product


def terms(raw: bytes) -> Iterator[list[bytes]]:
    for piece in pieces(raw.lower()):  # bytes.lower changes A-Z only; white space ends a term
        yield TERM.findall(piece)


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, times, docs: partial counts. A row without term names a group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[tuple, collections.Counter] = {}
        within: dict[tuple, collections.Counter] = {}
        held = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in times.items():
                words = list(found)
                for first in range(0, len(words) or 1, 50_000):
                    some = words[first : first + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * (len(some) + 1), pa.string()),
                            pa.array([source] * (len(some) + 1), pa.string()),
                            pa.array([None] + [w.decode("utf-8", "replace") for w in some], pa.string()),
                            pa.array([0] + [found[w] for w in some], pa.int64()),
                            pa.array([0] + [within[lang, source][w] for w in some], pa.int64()),
                        ],
                        ["lang", "source", "term", "times", "docs"],
                    )

        for batch in batches:
            for lang, source, text in zip(*(batch.column(n) for n in ("lang", "source", "text"))):
                group = lang.as_py(), source.as_py()
                all_times = times.setdefault(group, collections.Counter())
                all_docs = within.setdefault(group, collections.Counter())
                held -= len(all_times)
                seen: set[bytes] = set()
                for words in terms(text.as_py()):
                    all_times.update(words)
                    seen.update(words)
                all_docs.update(seen)
                held += len(all_times)
                if held > MOST_HELD:
                    yield from handed()
                    times, within, held = {}, {}, 0
        yield from handed()

    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(count, "lang string, source string, term string, times bigint, docs bigint")


def shares(times: np.ndarray, of: np.ndarray | int) -> np.ndarray:
    """floor(SCALE * (times + ADDED) / of) + 1, exact also where the product exceeds a long number."""
    if len(times) and int(times.max()) > (1 << 62) // SCALE:
        exact = [SCALE * (int(t) + ADDED) // int(n) + 1 for t, n in zip(times, np.broadcast_to(of, times.shape))]
        return np.array(exact, np.int64)
    return SCALE * (times + ADDED) // of + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)² / (p + q)); shares are at most SCALE + 1, so the square is a long number."""
    return (p - q) * (p - q) // (p + q)


def _joint(codes: np.ndarray, level: np.ndarray, owner: np.ndarray, n_groups: int, out: np.ndarray) -> None:
    """Adds the prices of one product: ``codes`` has the column of every group for each term, ``level``
    and ``owner`` the share and the group of each column."""
    n_terms, n_columns = len(codes), len(level)
    one_hot = np.zeros((n_terms, n_columns), np.float32)
    one_hot[np.arange(n_terms)[:, None], codes] = 1
    for x in range(0, n_columns, MOST_COLUMNS):
        left = slice(x, x + MOST_COLUMNS)
        for y in range(0, n_columns, MOST_COLUMNS):
            right = slice(y, y + MOST_COLUMNS)
            joint = (one_hot[:, left].T @ one_hot[:, right]).astype(np.int64)
            priced = joint * price(level[left, None], level[None, right])
            for axis, owners in ((0, owner[left]), (1, owner[right])):
                starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
                priced = np.add.reduceat(priced, starts, axis=axis)
            out[np.ix_(np.unique(owner[left]), np.unique(owner[right]))] += priced


def divergences(p: np.ndarray) -> np.ndarray:
    """For shares of terms (rows) in groups (columns), the summed price of every two groups."""
    n_terms, n_groups = p.shape
    out = np.zeros((n_groups, n_groups), np.int64)
    waiting = [p[np.argsort(p.sum(1), kind="stable")]]
    while waiting:
        rows = waiting.pop()
        columns = [np.unique(rows[:, g], return_inverse=True) for g in range(n_groups)]
        sizes = [len(levels) for levels, _ in columns]
        if sum(sizes) > max(MOST_COLUMNS, n_groups) and len(rows) > 1:
            half = len(rows) // 2
            waiting += [rows[:half], rows[half:]]
            continue
        first = np.r_[0, np.cumsum(sizes)]
        codes = np.column_stack([first[g] + code for g, (_, code) in enumerate(columns)])
        level = np.concatenate([levels for levels, _ in columns])
        _joint(codes, level, np.repeat(np.arange(n_groups), sizes), n_groups, out)
    return out


def _priced(key: tuple, block: pd.DataFrame, groups: pd.DataFrame, best: int) -> pd.DataFrame:
    """Rows (lang, source, part, item, value) of one block of terms: prices of pairs of sources summed
    over the block, and of each source the ``best`` terms of the block."""
    empty = pd.DataFrame({n: [] for n in ("lang", "source", "part", "item", "value")}).astype({"value": "int64"})
    if not len(groups) or not len(block):
        return empty
    lang, head = groups["lang"].iloc[0], groups.iloc[0]
    sources = list(head["sources"])
    total = np.array(head["totals"], np.int64) + ADDED * int(head["n_terms"])
    place = {s: n for n, s in enumerate(sources)}
    p = np.broadcast_to(shares(np.zeros(len(sources), np.int64), total), (len(block), len(sources))).copy()
    at = np.repeat(np.arange(len(block)), [len(s) for s in block["sources"]])
    to = np.array([place[s] for found in block["sources"] for s in found], np.int64)
    times = np.concatenate([np.asarray(t, np.int64) for t in block["times"]])
    p[at, to] = shares(times, total[to])
    q = shares(block["all_times"].to_numpy(np.int64), int(head["all_total"]) + ADDED * int(head["n_terms"]))

    found = divergences(p)
    x, y = np.nonzero(~np.eye(len(sources), dtype=bool))
    names = np.array(sources, object)
    out = [pd.DataFrame({"lang": lang, "source": names[x], "part": "pair", "item": names[y], "value": found[x, y]})]

    above = p[at, to] > q[at]
    at, to = at[above], to[above]
    value = price(p[at, to], q[at])
    word = block["term"].to_numpy(object)
    rank_of_word = np.empty(len(word), np.int64)
    rank_of_word[sorted(range(len(word)), key=lambda n: word[n].encode("utf-8", "surrogatepass"))] = np.arange(len(word))
    order = np.lexsort((rank_of_word[at], -value, to))
    at, to, value = at[order], to[order], value[order]
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else to
    nth = np.arange(len(to)) - np.repeat(starts, np.diff(np.r_[starts, len(to)]))
    top = nth < best
    out.append(
        pd.DataFrame({"lang": lang, "source": names[to[top]], "part": "term", "item": word[at[top]], "value": value[top]})
    )
    return pd.concat(out, ignore_index=True)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, best: int = BEST) -> DataFrame:
    """lang, source, part, item, value, rank: where every source of a language stands.

    Part ``pair`` has every other source of the language and the divergence from it, part ``term`` up to
    ``best`` terms that the source uses above the language's share. Terms are kept if they stand in at
    least ``least_docs`` documents of the language; all counts and prices are exact whole numbers. Null
    lang, source and text are empty texts. A group without kept terms has its pairs; in a language
    without kept terms every divergence is 0. Texts of any length are read in pieces, repeated rows
    count each, an empty table gives no rows, and other columns are not read.

    Tasks count before anything is shuffled, so a source with a third of all rows travels as its
    terms. A term's row holds its count in each source, and a block as many terms as keep rows times
    sources bounded. Prices of pairs are summed, and the best terms picked, in each task first.
    """
    partial = counted(docs)
    stored = materialise(
        partial.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs")),
        "term-counts",
    )
    in_source = F.struct("source", "times")
    kept = (
        stored.filter("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("times").alias("all_times"), F.collect_list(in_source).alias("found"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "all_times", F.col("found.source").alias("sources"), F.col("found.times").alias("times"))
    )
    kept = materialise(kept, "kept-terms")
    totals = (
        kept.select("lang", F.inline(F.arrays_zip("sources", "times"))).toDF("lang", "source", "times")
        .groupBy("lang", "source").agg(F.sum("times").alias("total"))
    )
    in_lang = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("all_times").alias("all_total"))
    named = stored.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left")
    none = F.lit(0).cast("bigint")
    of_group = F.struct("source", F.coalesce("total", none).alias("total"))
    groups = (
        named.groupBy("lang").agg(F.sort_array(F.collect_list(of_group)).alias("g"))
        .join(in_lang, "lang", "left")
        .select(
            "lang", F.col("g.source").alias("sources"), F.col("g.total").alias("totals"),
            F.coalesce("n_terms", none).alias("n_terms"), F.coalesce("all_total", none).alias("all_total"),
        )
    )
    groups = materialise(groups, "groups")

    size = F.greatest(F.lit(1), F.least(F.lit(TERMS_OF_BLOCK), F.lit(CELLS_OF_BLOCK) / F.size("sources")))
    n_blocks = F.ceil(F.col("n_terms") / F.floor(size)).cast("int").alias("n_blocks")
    blocks = groups.select("*", n_blocks).filter("n_terms > 0")
    of_blocks = blocks.select(*groups.columns, F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
    placed = kept.join(blocks.select("lang", "n_blocks"), "lang").select(
        *kept.columns, F.pmod(F.xxhash64("term"), "n_blocks").cast("int").alias("block")
    )
    def priced(key: tuple, block: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        return _priced(key, block, of, best)

    found = placed.groupBy("lang", "block").cogroup(of_blocks.groupBy("lang", "block")).applyInPandas(
        priced, "lang string, source string, part string, item string, value bigint"
    )
    found = materialise(found, "priced")
    other = groups.filter("n_terms = 0").select("lang", "sources", F.explode("sources").alias("source")).select(
        "lang", "source", F.explode(F.array_except("sources", F.array("source"))).alias("item"), none.alias("value")
    )
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(other).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    top = found.filter("part = 'term'").select(*columns, rank).filter(F.col("rank") <= best)
    return pairs.select(*columns, rank).unionByName(top)
