"""Operator 7 (native): placement by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size,
(offset + i * skip) mod size, from two hashes of its name. Shards take turns, each
claiming the first slot of its order that is still free, until the table is full; so
shards differ by one slot at most, and adding or removing a shard moves few keys besides its own. A key goes to the
shard that holds slot hash(key) mod size: one broadcast join with the table, whose size is
a parameter (the first prime from 100 slots a shard on), so the broadcast is bounded.

Keys with more rows than ``1 / SPLIT`` of a fair shard can be split: they get a sub-key from
a hash of another column, in as many parts as keep each below that. There are fewer than
SPLIT * shards such keys, so their table is bounded, too; they are counted with partial
aggregation, over all rows.

Hashes are the first 60 bits of MD5. A null key counts as the empty string; repeated rows of
one key go to one shard unless split; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = 8


def hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def first_prime(n: int) -> int:
    """The first prime from n on."""
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: list[str], size: int | None = None) -> list[int]:
    """For each slot the number of its shard."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have names, all different")
    size = first_prime(size or 100 * len(shards))
    if size < len(shards):
        raise ValueError("more shards than slots")
    at = [hash60(f"{s}:offset") % size for s in shards]
    skip = [hash60(f"{s}:skip") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    table = [-1] * size
    free = size
    while free:
        for s in range(len(shards)):
            while table[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % size
            table[at[s]] = s
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int) -> Column:
    """hash60 of the key's text, mod size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("long") % size


def place(df: DataFrame, key: str, shards: list[str], size: int | None = None, split_by: str | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` (number of the shard); with ``split_by``, hot keys are split by a hash of that column."""
    taken = {"slot", "shard"} & set(df.columns)
    if taken:
        raise ValueError(f"columns exist: {sorted(taken)}")
    table = lookup_table(shards, size)
    slots = df.sparkSession.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(table)), "array<int>")).alias("__slot", "shard"))
    name = F.col(key).cast("string")
    rows = df
    if split_by:
        counts = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
        total = df.count()
        part = max(1, total // (SPLIT * len(shards)))
        hot = counts.filter(F.col("__n") > part).withColumn("__parts", F.ceil(F.col("__n") / part).cast("long")).drop("__n")
        rows = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__key")), "left")
        own = F.conv(F.substring(F.md5(F.encode(F.coalesce(F.col(split_by).cast("string"), F.lit("")), "UTF-8")), 1, 15), 16, 10).cast("long")
        name = F.when(F.col("__parts").isNull(), name).otherwise(F.concat(F.coalesce(name, F.lit("")), F.lit("#"), (own % F.col("__parts")).cast("string")))
    rows = rows.withColumn("slot", slot_of(name, len(table)))
    out = rows.join(F.broadcast(slots), rows["slot"] == slots["__slot"])
    return out.select(*(df[c] for c in df.columns), "slot", "shard")
