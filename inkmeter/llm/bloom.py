"""A Bloom filter of the keys of a table, in DataFrame functions.

The filter is 64 bits to a row and is broadcast: at most ``max_bits`` / 64
rows of 16 bytes, whatever the table's size.  A key of the table is always
found; the share of other keys that is found too grows once the table has more
keys than the filter has room for, so callers let an exact join follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ROW = 16
PROBES = 3
MAX_BITS = 1 << 26


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    bits = 1024
    while bits < rows * BITS_PER_ROW and bits < max_bits:
        bits *= 2
    return bits


def positions(keys: list[str], bits: int) -> list[Column]:
    """The bits of a key, by double hashing."""
    first = F.pmod(F.xxhash64(*keys), F.lit(bits))
    step = F.pmod(F.xxhash64(*keys, F.lit("step")), F.lit(bits))
    return [F.pmod(first + F.lit(i) * step, F.lit(bits)) for i in range(PROBES)]


def set_bits(rows: DataFrame, keys: list[str], bits: int, times: int = 1) -> DataFrame:
    """The bits set at least ``times`` times, 64 to a row: word, bits."""
    hit = rows.select(F.explode(F.array(*positions(keys, bits))).alias("bit"))
    often = hit.groupBy("bit").count().where(F.col("count") >= times)
    return often.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")
    )


def with_possible(rows: DataFrame, keys: list[str], words: DataFrame, bits: int) -> DataFrame:
    """The rows with ``possible``: all bits of the key are set."""
    columns = rows.columns
    possible = F.lit(True)
    for i, position in enumerate(positions(keys, bits)):
        side = words.select(F.col("word").alias(f"word_{i}"), F.col("bits").alias(f"bits_{i}"))
        rows = rows.withColumn(f"bit_{i}", position)
        # At most max_bits / 64 rows, see the module's head
        rows = rows.join(
            F.broadcast(side), F.shiftright(f"bit_{i}", 6) == F.col(f"word_{i}"), "left"
        )
        possible = possible & F.coalesce(
            F.expr(f"getbit(bits_{i}, cast(bit_{i} & 63 AS int)) = 1"), F.lit(False)
        )
    return rows.select(*columns, possible.alias("possible"))
