"""Sharding by a permutation-filled lookup table.

Every shard walks its own permutation of a prime number of slots; shards take turns and claim the
next free slot of their walk, so slots end up even and removing a shard moves few keys. The table
is broadcast (its size is a parameter, not a function of the data), and a key is placed by
``table[hash(key) mod prime]`` in constant time, without a shuffle.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SLOTS = 4_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256("\x1f".join(map(str, parts)).encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = 65_537, weights: dict[str, int] | None = None, seed: int = 0) -> list[int]:
    """Slot -> index into ``shards``. A shard of weight w takes w turns a round (default 1)."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and not empty")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError("slots must be a prime of at least the number of shards")
    turns = [max(0, (weights or {}).get(s, 1)) for s in shards]
    if not any(turns):
        raise ValueError("all weights are zero")
    at = [_hash(seed, "offset", s) % slots for s in shards]
    step = [_hash(seed, "skip", s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for shard, n in enumerate(turns):
            for _ in range(n):
                while table[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % slots
                table[at[shard]] = shard
                free -= 1
                if not free:
                    return table


def place(df: DataFrame, key: str, shards: list[str], slots: int = 65_537, weights: dict[str, int] | None = None, seed: int = 0, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with ``slot`` and ``shard`` added for each row.

    Equal keys share a shard; a null key is hashed as a fixed value of its own; an empty table
    stays empty. Columns of ``df`` named like the two new ones are replaced.
    """
    spark = df.sparkSession
    table = lookup_table(shards, slots, weights, seed)
    look = spark.createDataFrame(pa.table({"look": pa.array(range(slots), pa.int64()), "shard": [shards[i] for i in table]}))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(df[key].cast("string"), F.lit("\x01null"))))
    hashed = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    keep = [c for c in df.columns if c not in (slot_col, shard_col)]
    rows = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(keep)], F.pmod(hashed, F.lit(slots)).alias("slot"))
    joined = rows.join(F.broadcast(look), F.col("slot") == F.col("look"), "left")  # MAX_SLOTS bounds the table
    return joined.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))


def oracle(shards: list[str], slots: int = 65_537) -> str:
    """The placement of ``documents`` by doc_id in SQL; the table itself, which SQL cannot fill, is written out."""
    table = ",".join(map(str, lookup_table(shards, slots)))
    names = ",".join(f"'{s}'" for s in shards)
    return f"""
with t as (select [{table}] as look, [{names}] as names),
d as (select doc_id, cast('0x' || substr(md5('0:' || coalesce(cast(doc_id as varchar), chr(1) || 'null')), 1, 15) as bigint) % {slots} as slot from documents)
select doc_id, slot, names[look[slot + 1] + 1] as shard from d, t
"""
