"""Documents whose word n-grams overlap, by a join of sets with a token-group matrix.

Sets are ordered by rarity, and of each only a head is matched: as many of its rarest tokens as must hold
a few tokens of any set that reaches the threshold. Sets are first tied to the set at the
centre of most tokens of their head; what such ties connect is a group. The token-group matrix has a row for every token and
group in whose union of heads it stands, however many members have it. Tokens that a query shares with
that union bound its overlap with each member, so only groups with enough of them are opened, and only
by queries of another, smaller group: members of one group are connected already. Opened members that
share enough tokens of the head are compared whole. The answer is exact whatever the groups are.

Rarity comes from counts of the frequent tokens, at most ``MOST_HOT`` of them, so that a passage of many
documents is matched last. The order decides how much is compared and never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.words import ngram_hashes, raw_bytes, word_hashes
from daybook.session import materialise

SHINGLE, PERCENT = 4, 85
MOST_COMMON, TOKENS_OF_COMMON = 2, 16
MOST_HOT, LEAST_HOT = 1 << 20, 8
TOKENS_COUNTED = 1 << 20  # tokens of texts that a task counts at once
MOST_BROADCAST, KEY_BYTES = 32 << 20, 48  # of the texts that are wanted
MOST_SEEN = 1 << 20  # sets that a task remembers, not to send them twice


def tokens_of(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct runs of ``size`` words as sorted 64-bit hashes; one run of all words if there are fewer."""
    words = word_hashes(raw_bytes(text).lower())  # bytes.lower changes A-Z only
    if not len(words):
        return np.empty(0, np.int64)
    return np.unique(ngram_hashes(words, min(size, len(words))).view(np.int64))


def set_key(tokens: np.ndarray) -> int | None:
    """One number for a set, so that equal sets are compared once; None for an empty one."""
    if not len(tokens):
        return None
    return int(np.array([xxhash.xxh3_64_intdigest(tokens.tobytes())], np.uint64).view(np.int64)[0]) 


def needed(n: int, percent: int = PERCENT) -> int:
    """The least overlap of a set of ``n`` tokens with any set that reaches the threshold."""
    return -(-percent * n // 100)


def least_size(percent: int = PERCENT) -> int:
    """Sets of fewer tokens reach the threshold with equal sets only."""
    return -(-percent // (100 - percent))


def common(n: int) -> int:
    """How many tokens the head of a set of ``n`` shares with that of any set, no smaller, that reaches the
    threshold with it: the more are asked for, the longer are heads and the fewer sets meet by chance."""
    return max(1, min(MOST_COMMON, n // TOKENS_OF_COMMON))


def _common(n: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(MOST_COMMON), F.floor(n / TOKENS_OF_COMMON)))


def described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, set and n of every row; and rows (token, times) without text_key, how many
    different sets that a task read at once have a token that is frequent among them."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size_held = 0

        def frequent() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= max(2, size_held // MOST_HOT)
            return rows(token=pa.array(token[often]), times=pa.array(times[often].astype(np.int64)))

        def rows(**columns: pa.Array) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            names = ["doc_id", "text_key", "set", "n", "token", "times"]
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, pa.int64())) for c in names], names)

        for batch in batches:
            keys, sizes = [], []
            for text in batch.column("text"):
                tokens = tokens_of(text.as_py(), size)
                keys.append(set_key(tokens))
                sizes.append(len(tokens))
                if keys[-1] is not None and keys[-1] not in seen:
                    seen.add(keys[-1])
                    held.append(tokens)
                    size_held += len(tokens)
                if size_held > TOKENS_COUNTED:
                    yield frequent()
                    held, seen, size_held = [], set(), 0
            yield rows(
                doc_id=batch.column("doc_id"), text_key=batch.column("text_key"),
                set=pa.array(keys, pa.int64()), n=pa.array(sizes, pa.int64()),
            )
        if held:
            yield frequent()

    kind = "doc_id bigint, text_key bigint, `set` bigint, n bigint, token bigint, times bigint"
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(describe, kind)


def hot_tokens(counted: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens, sorted, and the power of two of their counts: at most ``MOST_HOT`` of them, since
    that many counts of ``total`` / ``MOST_HOT`` add up to all tokens there are."""
    least = max(LEAST_HOT, total // MOST_HOT + 1)
    found = counted.groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= least).toArrow()
    token, times = (found.column(c).to_numpy() for c in ("token", "times"))
    order = np.argsort(token)
    return token[order].astype(np.int64), np.log2(np.maximum(times[order], 1)).astype(np.uint8)


def head(tokens: np.ndarray, hot: np.ndarray, power: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The rarest tokens of a set, ``common`` of which stand in the head of any set that reaches the
    threshold, and how many of them, the first ones, are not among the frequent."""
    rank = np.zeros(len(tokens), np.uint8)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
        rank = np.where(hot[at] == tokens, power[at], 0)
        order = np.argsort(rank, kind="stable")
        tokens, rank = tokens[order], rank[order]
    n = len(tokens) - needed(len(tokens), percent) + common(len(tokens))
    return tokens[:n], int(np.count_nonzero(rank[:n] == 0))


def heads(docs: DataFrame, hot: np.ndarray, power: np.ndarray, size: int, percent: int) -> DataFrame:
    """set, rare and frequent, the two parts of the head of every set that may reach the threshold with a
    different one; a task sends a set once."""

    def lists(found: list[np.ndarray]) -> pa.Array:
        offsets = pa.array(np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, rare, frequent = [], [], []
            for text in batch.column("text"):
                tokens = tokens_of(text.as_py(), size)
                key = set_key(tokens)
                if len(tokens) < least_size(percent) or key in seen:
                    continue
                seen = seen if len(seen) < MOST_SEEN else set()
                seen.add(key)
                found, n_rare = head(tokens, hot, power, percent)
                keys.append(key)
                rare.append(found[:n_rare])
                frequent.append(found[n_rare:])
            columns = [pa.array(keys, pa.int64()), lists(rare), lists(frequent)]
            yield pa.RecordBatch.from_arrays(columns, ["set", "rare", "frequent"])

    return docs.select("text").mapInArrow(cut, "`set` bigint, rare array<bigint>, frequent array<bigint>")


def _shared(tokens: DataFrame) -> DataFrame:
    """The tokens of more than one set, and the last place of each."""
    ends = tokens.groupBy("token").agg(
        F.min("set").alias("least"), F.max("set").alias("most"), F.max("at").alias("last")
    )
    return ends.filter("least != most").select("token", "last")


def active_tokens(cut: DataFrame) -> DataFrame:
    """token, set, at: the tokens of heads that stand in another head as well, with their places.

    Tokens that are not among the frequent stand in less than two in ``MOST_HOT`` of all places, so they
    are dealt by token once, and counted and joined where they lie. The frequent ones are summed in each
    task and joined with their own short table.
    """

    def exploded(part: str, before: Column) -> DataFrame:
        placed = cut.select("set", before.alias("before"), F.posexplode(part).alias("at", "token"))
        return placed.select("token", "set", (F.col("at") + F.col("before")).alias("at"))

    rare = exploded("rare", F.lit(0)).repartition("token")
    frequent = exploded("frequent", F.size("rare"))
    of_frequent = materialise(_shared(frequent), "frequent-tokens")
    # no place is beyond the last: asked so that both sides need the same columns and share one shuffle
    both = rare.join(_shared(rare), "token").filter("at <= last").drop("last").unionByName(
        frequent.join(of_frequent.select("token"), "token")
    )
    return both.distinct()  # tasks may have sent the same set


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set and text of the ``wanted`` sets (set, text_key, least), from one row of ``docs`` each."""
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), "text")
    same = F.col("id").eqNullSafe(F.col("least"))
    if wanted.count() * KEY_BYTES <= MOST_BROADCAST:  # else the texts are dealt by their keys
        wanted = F.broadcast(wanted)
    found = materialise(rows.join(wanted, "text_key").filter(same).select("set", "text"), "texts")
    rows, sets = found.agg(F.count("set"), F.count_distinct("set")).first()
    return found if rows == sets else materialise(found.groupBy("set").agg(F.first("text").alias("text")), "texts")


def links(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sets reach the threshold, each pair compared whole, from the texts."""
    either = pairs.select(F.explode(F.array("u", "v")).alias("set")).distinct()
    wanted = materialise(sizes.join(either, "set").select("set", "text_key", "least"), "wanted")
    texts = texts_of(docs, wanted)
    of_u = texts.join(pairs, F.col("set") == F.col("u")).select("u", "v", F.col("text").alias("of_u"))
    of_v = texts.join(pairs.select("v").distinct(), F.col("set") == F.col("v"), "left_semi")
    both = of_u.join(of_v.select(F.col("set").alias("v"), F.col("text").alias("of_v")), "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0

        def tokens(key: int, text: str) -> np.ndarray:
            nonlocal held
            if key not in known:
                if held > TOKENS_COUNTED:
                    known.clear()
                    held = 0
                known[key] = tokens_of(text, size)
                held += len(known[key])
            return known[key]

        for batch in batches:
            found = []
            for u, v, x, y in zip(*(batch.column(c) for c in ("u", "v", "of_u", "of_v"))):
                a, b = tokens(u.as_py(), x.as_py()), tokens(v.as_py(), y.as_py())
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    found.append((u.as_py(), v.as_py()))
            columns = [pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    return both.mapInArrow(compare, "u bigint, v bigint")


def _overlap(n_u: Column, n_v: Column, percent: int) -> Column:
    """The least overlap with which sets of these sizes reach the threshold."""
    return F.ceil((n_u + n_v) * percent / (100 + percent))


def in_groups(active: DataFrame, sets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """token, set, at, n, alone, group, members: the tokens of heads, with the group of their set and how
    many tokens of its head it has alone. Token tables grow with the data, so they are merged at any size."""
    own = sets.withColumns({"group": F.col("set"), "members": F.lit(1).cast("bigint")})
    if roots is not None:
        members = roots.groupBy("root").agg(F.count("*").alias("of_root"))
        found = sets.join(roots.join(members, "root"), F.col("set") == F.col("node"), "left")
        own = found.select(
            *sets.columns, F.coalesce("root", "set").alias("group"), F.coalesce("of_root", F.lit(1)).alias("members")
        )
    return materialise(active.join(own.hint("merge"), "set"), "in-groups")


def ties(named: DataFrame, percent: int) -> DataFrame:
    """u, v: each set and, of the sets at the centre of its tokens, the one that most of them name.

    The centre of a token is, in the greatest group that has it, the set with the fewest tokens alone: the
    original of many near copies rather than one of them. There is one row a token and set, whatever the
    size of a group.
    """
    centre = named.groupBy("token").agg(
        F.max(F.struct("members", (-F.col("alone")).alias("shared"), "set", "n", "group")).alias("c")
    ).select("token", F.col("c.set").alias("v"), F.col("c.n").alias("n_v"), F.col("c.group").alias("of"))
    fits = F.least("n", "n_v") * 100 >= F.greatest("n", "n_v") * percent
    votes = named.join(centre.hint("merge"), "token").filter((F.col("group") != F.col("of")) & fits)
    votes = votes.groupBy("set", "n", "v").count().filter(F.col("count") >= _common(F.col("n")))
    best = votes.groupBy("set").agg(F.max_by("v", F.struct("count", "v")).alias("v"))
    return best.select(F.col("set").alias("u"), "v")


def opened(named: DataFrame, percent: int) -> DataFrame:
    """u, v: sets of different groups whose heads share enough tokens, by the token-group matrix.

    A token's rows are its groups, however many members have it, and every two groups are looked at once:
    the sets of the smaller one (of equal ones that of the lesser name) are queries of the other. Two sets
    that reach the threshold share ``common`` tokens no later in either than its size less the overlap
    that their sizes need. So a pair of groups is opened if their unions share as many tokens that may be
    early enough for sizes they have, and in it two sets are compared if they do; groups of one set
    each are compared at once.
    """
    matrix = named.groupBy("token", "group", "members").agg(
        F.min("n").alias("n_least"), F.max("n").alias("n_most"), F.min("at").alias("at")
    )
    matrix = materialise(matrix, "token-groups")
    spread = matrix.groupBy("token").agg(F.min("group").alias("a"), F.max("group").alias("b")).filter("a != b")
    matrix = materialise(matrix.join(spread.select("token").hint("merge"), "token", "left_semi"), "spread-tokens")
    of = matrix.select(*(F.col(c).alias(f"of_{c}") for c in matrix.columns))
    least, most, of_least, of_most = (F.col(c) for c in ("n_least", "n_most", "of_n_least", "of_n_most"))
    lesser = F.least(least, of_least)

    def early(at: str, n: Column, other: Column, smaller: Column) -> Column:
        return F.col(at) < n - _overlap(n, other, percent) + _common(smaller)

    met = matrix.join(
        of.hint("merge"),
        (F.col("token") == F.col("of_token"))
        & F.expr("struct(members, `group`) < struct(of_members, of_group)")
        & (of_least * percent <= most * 100) & (least * percent <= of_most * 100)
        # the greatest size of one with the least of the other lets a token be latest
        & early("at", most, of_least, F.least(most, of_most)) & early("of_at", of_most, least, F.least(most, of_most)),
    ).select(
        "token", "group", F.col("of_group").alias("to"), lesser.alias("n_least"),
        (F.col("of_members") == 1).alias("single"),  # then the smaller group has one member, too
    )
    met = materialise(met, "met")
    enough = met.groupBy("group", "to", "single").agg(F.count("*").alias("common"), F.min("n_least").alias("n_least"))
    enough = materialise(enough.filter(F.col("common") >= _common(F.col("n_least"))), "opened")
    of_one = enough.filter("single").select(F.col("group").alias("u"), F.col("to").alias("v"))
    several = met.filter("NOT single").join(
        enough.filter("NOT single").select("group", "to").hint("merge"), ["group", "to"], "left_semi"
    )
    asked = several.select("token", "group", "to").join(
        named.select("token", "group", "set", "n", "at").hint("merge"), ["token", "group"]
    )
    inside = named.select(
        F.col("token").alias("of_token"), F.col("group").alias("of_group"), F.col("set").alias("v"),
        F.col("n").alias("n_v"), F.col("at").alias("at_v"),
    )
    n, n_v = F.col("n"), F.col("n_v")
    fits = (n * percent <= n_v * 100) & (n_v * percent <= n * 100)
    fits = fits & early("at", n, n_v, F.least(n, n_v)) & early("at_v", n_v, n, F.least(n, n_v))
    same = (F.col("token") == F.col("of_token")) & (F.col("to") == F.col("of_group"))
    pairs = asked.join(inside.hint("merge"), same & fits).groupBy("set", "n", "v", "n_v").count()
    pairs = pairs.filter(F.col("count") >= _common(F.least(n, n_v)))
    return of_one.unionByName(pairs.select(F.col("set").alias("u"), "v"))


def groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Documents link when their sets of ``size``-word runs overlap in ``percent`` of their union; a component
    is named by its smallest doc_id and is null only if all its rows lack one. Null and empty texts, and
    texts without words, have an empty set and are components of their own. Equal sets are one set
    throughout, so copies cost one row each and their component is found once. Texts of any length are
    read whole; an empty table gives no rows; columns other than doc_id and text are not read. Sets are
    told apart by 64-bit hashes of their tokens. ``percent`` is 51 to 99.
    """
    if not 50 < percent < 100:
        raise ValueError("percent is 51 to 99")
    seen = materialise(described(docs, size), "sets")
    rows = seen.filter("text_key IS NOT NULL").select("doc_id", "text_key", "set", "n")
    least = F.min("doc_id").alias("least")
    key = F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key")
    in_sets = rows.filter("`set` IS NOT NULL").groupBy("set")
    sizes = materialise(in_sets.agg(F.min("n").alias("n"), key, least), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot, power = hot_tokens(seen.filter("token IS NOT NULL"), total)

    active = materialise(active_tokens(materialise(heads(docs, hot, power, size, percent), "heads")), "active")
    n, shared = F.col("n"), active.groupBy("set").agg(F.count("*").alias("shared"))
    alone = (n - F.ceil(n * percent / 100) + _common(n) - F.col("shared")).alias("alone")
    may_link = sizes.join(shared, "set").filter(F.col("shared") >= _common(n))
    sets = materialise(may_link.select("set", "n", alone), "sets-of-heads")

    pairs = materialise(ties(in_groups(active, sets, None), percent), "pairs")
    tied = materialise(links(pairs, docs, sizes, size, percent), "ties")
    pairs = materialise(opened(in_groups(active, sets, components(tied)), percent), "pairs")
    roots = components(tied.unionByName(links(pairs, docs, sizes, size, percent)))

    named = sizes.join(roots, F.col("set") == F.col("node"), "left").select(
        "set", "least", F.coalesce("root", "set").alias("root")
    )
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = materialise(named.join(component, "root").select("set", "component_id"), "component")
    own = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(of_set, "set", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
