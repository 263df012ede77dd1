"""Placing rows on shards by a lookup table filled from permutations.

Each shard has its own order of preference over the slots of a table of prime size,
given by an offset and a step. Shards take turns, each claiming its next free slot,
until the table is full; so each shard gets a near-equal number of slots, and a shard
that joins or leaves moves few slots of the others. A row's key hashes to a slot. The
table is small and fixed (at most MAX_SLOTS rows) and is sent to all tasks.

Defined cases: null keys share one slot; repeated keys have one slot; no rows give no
rows; columns ``slot`` and ``shard`` are added, and replaced where they exist.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65537
MAX_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, salt: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=salt).digest(), "little")


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and step of a shard's permutation of the slots."""
    return _number(shard, b"offset") % slots, _number(shard, b"step") % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The table: for each slot the index of its shard."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct, and at least one")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"{slots} slots: want a prime from the number of shards to {MAX_SLOTS}")
    table = [-1] * slots
    place, step = map(list, zip(*(preference(s, slots) for s in shards), strict=True))
    left = slots
    while left:
        for shard in range(len(shards)):
            at = place[shard]
            while table[at] >= 0:
                at = (at + step[shard]) % slots
            table[at] = shard
            place[shard] = (at + step[shard]) % slots
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column | str, slots: int = SLOTS) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def place(df: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with the slot and the shard of each row."""
    names = list(shards)
    table = [(slot, names[shard]) for slot, shard in enumerate(fill(names, slots))]
    lookup = df.sparkSession.createDataFrame(table, "slot int, shard string")
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    # The row's own columns stand apart, so none can clash with the inner ones.
    rows = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"), slot_of(key, slots).alias("slot"))
    found = rows.join(F.broadcast(lookup), "slot", "left")
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], "slot", "shard")


def write_shards(df: DataFrame, folder: str, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> None:
    """One folder per shard; a task writes its rows of each shard, so no shard is one task."""
    place(df, shards, key, slots).drop("slot").write.partitionBy("shard").parquet(folder)
