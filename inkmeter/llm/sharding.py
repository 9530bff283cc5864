"""Sharding by a lookup table that shards fill in turns.

Each shard has its own order of preference over the slots of a table of prime
size, given by a start and a stride hashed from its name.  Shards take turns,
each claiming the first free slot of its order, until the table is full, so
shards of equal weight differ by one slot at most, and when a shard comes or
goes few slots change hands.  A row's slot is its key's hash modulo the table
size; the table, of fixed size, is broadcast, so placing a row is one lookup
and moves nothing.

Cases: rows of equal keys always share a shard.  Rows of a null key have
nothing to be kept together by and are placed by their whole content, so that
many of them do not fill one shard.  Repeated rows share a shard.  An empty
table gives an empty result.  Result columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode()).digest()
    start = int.from_bytes(digest[:8]) % size
    return start, int.from_bytes(digest[8:16]) % (size - 1) + 1


def fill_table(
    shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[float] | None = None
) -> list[int]:
    """The shard number of every slot; a shard of half the weight has half the turns."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table needs a prime size, no less than the number of shards")
    weights = weights or [1.0] * len(shards)
    if len(weights) != len(shards) or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights are not negative, one for each shard, and not all zero")
    # By name, so that the order in which shards are listed decides nothing
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    order = [_preference(name, size) for name in shards]
    share = [w / max(weights) for w in weights]
    owner, tried, claimed, round_no = [-1] * size, [0] * len(shards), 0, 0
    while True:
        for i in turns:
            if int((round_no + 1) * share[i]) == int(round_no * share[i]):
                continue
            start, stride = order[i]
            while owner[(start + tried[i] * stride) % size] >= 0:
                tried[i] += 1
            owner[(start + tried[i] * stride) % size] = i
            claimed += 1
            if claimed == size:
                return owner
        round_no += 1


def place(
    df: DataFrame,
    key: str,
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
    weights: Sequence[float] | None = None,
) -> DataFrame:
    """The rows with slot and shard."""
    owner = json.dumps([shards[i] for i in fill_table(shards, size, weights)])
    lookup = df.sparkSession.range(1).select(
        F.posexplode(F.from_json(F.lit(owner), "array<string>")).alias("slot", "shard")
    )
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = F.when(F.col(key).isNull(), F.xxhash64(*columns)).otherwise(
        F.xxhash64(F.col(key).cast("string"))
    )
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.pmod(hashed, F.lit(size)).cast("int").alias("slot"),
    )
    # One row a slot: the table's size is fixed
    return rows.join(F.broadcast(lookup), "slot").select("row.*", "slot", "shard")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """One folder a shard.  Rows of a shard are dealt to several tasks and files."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files_per_shard))
    placed.withColumn("salt", salt).repartition("shard", "salt").drop("salt").write.partitionBy(
        "shard"
    ).parquet(path)
