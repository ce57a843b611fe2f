"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; the shards take
turns and each claims the first slot of its order that is still free. Shards end up within one slot of
each other, and when a shard is added or removed few slots change owner. A row's key is hashed to a
slot; the table's size is fixed, so it is broadcast and each row is placed by one look-up.

A row all of whose keys are null is placed by a hash of the whole row, so that such rows spread too.
Equal rows go to the same shard. Empty tables give empty results; texts are not read. Result columns
(``slot``, ``shard``) replace input columns of their name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """A shard's first slot and its stride; with a prime number of slots it visits all of them."""
    digest = hashlib.sha256(name.encode()).digest()
    first, stride = (int.from_bytes(digest[k : k + 8], "little") for k in (0, 8))
    return first % slots, stride % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """Which shard (by index) owns each slot."""
    if not is_prime(slots) or not 0 < len(shards) <= slots:
        raise ValueError("the table needs a prime number of slots, and a slot for every shard")
    if len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    owner = np.full(slots, -1, np.int32)
    at, stride = (np.array(x, np.int64) for x in zip(*(preference(s, slots) for s in shards)))
    left = slots
    while left:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + stride[k]) % slots
            owner[at[k]] = k
            left -= 1
            if not left:
                break
    return owner


def place(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    shards: Sequence[str] | int = SHARDS,
    slots: int = SLOTS,
) -> DataFrame:
    """Add ``slot`` and ``shard`` (index into ``shards``) to every row."""
    names = [f"shard-{k:05d}" for k in range(shards)] if isinstance(shards, int) else list(shards)
    owner = lookup_table(names, slots)
    table = docs.sparkSession.createDataFrame(
        pd.DataFrame({"slot": np.arange(slots, dtype=np.int32), "shard": owner})
    )
    unkeyed = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    every = [F.col(c).cast("string") for c in docs.columns]
    digest = F.when(unkeyed, F.xxhash64(*every)).otherwise(F.xxhash64(*[F.col(k).cast("string") for k in keys]))
    hashed = docs.withColumn("slot", F.pmod(digest, F.lit(slots)).cast("int"))
    return hashed.drop("shard").join(F.broadcast(table), "slot").select(
        *[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard"
    )
