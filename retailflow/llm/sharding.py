"""Sharding: a permutation-filled lookup table.

Each shard has its own order of the slots of a table of prime size (offset and skip from its name's hash; any skip
below a prime reaches every slot).  Shards take turns claiming their next free slot until the table is full, so
every shard owns nearly the same number of slots, and a shard added or removed moves few slots between the others.
A key's place is its hash modulo the table size: one lookup.  The table has a fixed size whatever the data, so it
is sent to every task.

Cases.  Weights make a shard claim more often (a turn adds its weight, it claims for every whole unit).  A null
key is the empty key.  Repeated rows go to the same shard.  A column named ``slot`` or ``shard`` in the input is
replaced.  An empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # prime


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:7], "big")


def fill(shards: list[str], weights: list[float] | None = None, slots: int = SLOTS) -> np.ndarray:
    """The shard number of every slot."""
    if not shards or slots < 2 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("needs shards and a prime number of slots")
    weights = weights or [1.0] * len(shards)
    if min(weights) <= 0 or len(weights) != len(shards):
        raise ValueError("one positive weight per shard")
    offset = [_number(f"offset/{s}") % slots for s in shards]
    skip = [_number(f"skip/{s}") % (slots - 1) + 1 for s in shards]
    place, due = [0] * len(shards), [0.0] * len(shards)
    owner, free = np.full(slots, -1, np.int32), slots
    most = max(weights)
    while free:
        for i, w in enumerate(weights):
            due[i] += w / most
            while due[i] >= 1 and free:
                due[i] -= 1
                while owner[at := (offset[i] + place[i] * skip[i]) % slots] >= 0:
                    place[i] += 1
                owner[at] = i
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """First 60 bits of the key's md5 modulo the table size."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: Column, shards: list[str], weights: list[float] | None = None, slots: int = SLOTS) -> DataFrame:
    """``df`` with the slot and the shard name of every row; no shuffle, the table is broadcast (``slots`` rows, fixed)."""
    spark = df.sparkSession
    owner = fill(shards, weights, slots)
    lookup = spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner.tolist())], "slot long, shard string")
    keyed = df.drop("shard").withColumn("slot", slot_of(key, slots))
    return keyed.join(F.broadcast(lookup), "slot").select(*[c for c in keyed.columns if c != "slot"], "slot", "shard")
