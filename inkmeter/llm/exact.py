"""Exact dedup by two passes of a Bloom filter.

The first pass sets, for every text, a few bits chosen by its hash, and keeps
the bits that were set at least twice.  The second pass looks each text up: if
one of its bits was set only once, no equal text exists, and the row passes
straight through.  Only the other rows, the true copies and a small share of
chance hits, shuffle; grouping them by the full digest decides exactly.

The filter is sized by the row count up to ``max_bits`` and so is what is
broadcast: at most max_bits / 64 words of 16 bytes.  Beyond that bound more
single rows are taken for possible copies and shuffle (a digest and an id
each); the result is the same.  Counting bits combines on the map side, and
adaptive execution splits the join of a large group of copies.

Cases: null text is empty text; texts are equal when they are after
lower-casing A-Z.  Of equal texts the row with the largest id stays, null ids
last; of repeated rows (same id, equal text) one stays.  An empty table gives
an empty result.  Further columns are never looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.bloom import MAX_BITS, filter_bits, set_bits, with_possible
from inkmeter.llm.staging import fold_ascii, stage



def text_digest(text: Column) -> Column:
    return F.sha2(fold_ascii(text), 256)


class Copies:
    """The groups of equal texts of one table, found through the filter."""

    def __init__(self, docs: DataFrame, key: str, text: str, max_bits: int) -> None:
        self.hashes = stage(
            docs.select(F.col(key).alias("id"), text_digest(F.col(text)).alias("digest"))
        )
        self.bits = filter_bits(self.hashes.count(), max_bits)
        self.seen_twice = stage(set_bits(self.hashes, ["digest"], self.bits, times=2))
        marked = with_possible(self.hashes, ["digest"], self.seen_twice, self.bits)
        self.single = marked.where("NOT possible").drop("possible")
        # Repeated rows count as one with their number
        self.counted = (
            marked.where("possible").groupBy("digest", "id").agg(F.count("*").alias("times"))
        )
        self.groups = stage(
            self.counted.groupBy("digest")
            .agg(F.max("id").alias("keep_id"), F.sum("times").alias("group_size"))
            .where("group_size > 1")
        )


def mark_exact(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256."""
    copies = Copies(docs, key, text, max_bits)
    grouped = (
        copies.counted.join(copies.groups, "digest", "left")
        .withColumn("first", F.coalesce(F.col("id").eqNullSafe(F.col("keep_id")), F.lit(True)))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select(
            F.col("id").alias(key),
            F.when(F.col("group_size").isNull(), F.col("id"))
            .otherwise(F.col("keep_id"))
            .alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.col("group_size").isNull() | (F.col("first") & (F.col("copy") == 1))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )
    single = copies.single.select(
        F.col("id").alias(key),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return single.unionByName(grouped)


def keep_exact(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents that stay, with the columns they came with."""
    copies = Copies(docs, key, text, max_bits)
    rows = with_possible(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            F.col(key).alias("id"),
            text_digest(F.col(text)).alias("digest"),
        ),
        ["digest"],
        copies.seen_twice,
        copies.bits,
    )
    maybe = rows.where("possible").join(copies.groups, "digest", "left")
    alone = maybe.where("group_size IS NULL").select("row")
    # Repeated rows of the one that stays are dropped by an aggregate, which combines map-side
    first = maybe.where("group_size IS NOT NULL AND id <=> keep_id").dropDuplicates(
        ["digest", "id"]
    )
    kept = rows.where("NOT possible").select("row").union(alone).union(first.select("row"))
    return kept.select("row.*")
