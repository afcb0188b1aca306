"""Shards by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table. The shards take turns, each
claiming the first slot of its permutation that is still free, until none is free. All shards own
the same number of slots but for one, and when a shard goes, few slots of the others move. A row
finds its shard by one look at the table, which is broadcast: its size is the parameter ``slots``.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import packed, unpacked

SLOTS = 65537
MOST_SLOTS = 1 << 20


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.md5(f"{purpose}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The owner of each slot, as an index into ``shards``."""
    if not is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"slots must be a prime of at most {MOST_SLOTS}, not {slots}")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, at least one and no more than slots")
    at = [_number(name, "start") % slots for name in shards]
    step = [_number(name, "step") % (slots - 1) + 1 if slots > 2 else 1 for name in shards]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:  # the steps of a prime table visit every slot once
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(doc_id: Column, text: Column, slots: int) -> Column:
    key = F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    return F.pmod(key, F.lit(slots)).cast("int")


def shard(docs: DataFrame, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``docs`` with the columns slot (int) and shard (string).

    A row is placed by its doc_id, so repeated rows and copies of one id share a shard; a row without
    doc_id is placed by its text, and one with neither by a constant. Columns already named slot or
    shard are replaced. An empty table gives an empty table with these columns.
    """
    owners = pa.table(
        {
            "slot": pa.array(range(slots), pa.int32()),
            "shard": pa.array([shards[i] for i in lookup_table(shards, slots)], pa.string()),
        }
    )
    places = F.broadcast(docs.sparkSession.createDataFrame(owners))
    rows = packed(docs, slot=slot_of(docs["doc_id"], docs["text"], slots))
    return unpacked(rows.join(places, "slot"), docs, slot=F.col("slot"), shard=F.col("shard"))
