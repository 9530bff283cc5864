"""I-Match fingerprints over randomised lexicons.

A text's terms are its distinct words, lower-cased.  Terms are kept within a
band of inverse document frequency: those in more than ``common`` of all
documents say little, those in less than ``rare`` of them are mostly noise.
Both ends are shares of the corpus, so the band is bounded: a term of it is
in at least a share of all documents, hence there are at most (distinct terms
of a mean document) / rare of them, however large the corpus.  Up to
``most_terms`` of them are a hash table inside the plan, and fingerprinting a
row moves nothing; more are joined to the distinct texts' terms.  Both ways
give the same fingerprints, and no term of the band is left out.

The lexicons are random subsets of the band, the same for all documents: eight
for each of four shares, a quarter to a 256th of the band.  A fingerprint has
one hash for each lexicon, of all the text's sorted terms in it.  A hash
survives an edit when no changed term is in its lexicon, so the sparse ones
tell how much large edits have left and the dense ones see small edits.  The
likeness of two texts is the share of equal hashes.  A text without terms in a
lexicon takes a hash of all its terms there: having none in common is not alike.

Cases: null text is empty.  A text without terms in the band uses all its
terms; one without words hashes its white space, so that equal texts, and no
others, are alike.  Repeated rows have equal fingerprints.  Rows of null ids
come last in the order of ids.  An empty table gives an empty result.  Further
columns are never looked at, whatever their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter.llm.staging import WORD_BREAK, stage

COMMON = 1 / 50
RARE = 1 / 2000
MOST_TERMS = 1 << 17
#: One lexicon each; it holds one in 2**bits of the terms
LEXICON_BITS = (2,) * 8 + (4,) * 8 + (6,) * 8 + (8,) * 8
SEED = 3
NEIGHBOUR_RANGES = 4096


def terms(text: Column) -> Column:
    """64-bit hashes of the distinct lower-cased words."""
    words = F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def band(
    docs: DataFrame, text: str = "text", common: float = COMMON, rare: float = RARE
) -> DataFrame:
    """The terms (their hashes) whose document frequency lies in the band."""
    found = docs.select(terms(F.coalesce(F.col(text), F.lit(""))).alias("terms"))
    rows = docs.count()
    return stage(
        found.select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("documents"))
        .where(
            (F.col("documents") >= math.ceil(rare * rows))
            & (F.col("documents") <= max(1, math.floor(common * rows)))
        )
        .select("term")
    )


class Fingerprinter:
    """The fingerprint of a text over the terms of one band."""

    def __init__(
        self,
        kept: DataFrame,
        most_terms: int = MOST_TERMS,
        lexicon_bits: tuple[int, ...] = LEXICON_BITS,
        seed: int = SEED,
    ) -> None:
        self.kept, self.lexicon_bits, self.seed = kept, lexicon_bits, seed
        held = kept.count()
        self.in_plan = held <= most_terms
        if not self.in_plan:
            return
        slots = 1
        while slots < held:
            slots *= 2
        table: list[list[int]] = [[] for _ in range(slots)]
        for row in kept.collect():  # at most most_terms
            table[row["term"] % slots].append(row["term"])
        # Folded into one constant when the plan is optimised
        self.table = F.from_json(F.lit(json.dumps(table)), "array<array<bigint>>")
        self.slots = slots

    def _in_band(self, found: Column) -> Column:
        def known(term: Column) -> Column:
            slot = F.pmod(term, F.lit(self.slots)).cast("int")
            return F.array_contains(F.get(self.table, slot), term)

        return F.filter(found, known)

    def _joined(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """The rows with the terms of the band, looked up by a join."""
        key = F.sha2(F.col(text), 256)
        texts = df.select(key.alias("text_key"), terms(F.col(text)).alias("terms"))
        # A text's own terms are what one group holds; the band is bounded, see above
        found = (
            texts.dropDuplicates(["text_key"])
            .select("text_key", F.explode("terms").alias("term"))
            .join(F.broadcast(self.kept), "term")
            .groupBy(F.col("text_key").alias(f"{out}_key"))
            .agg(F.collect_list("term").alias(f"{out}_found"))
        )
        return df.join(found, key == F.col(f"{out}_key"), "left").withColumn(
            f"{out}_band", F.coalesce(f"{out}_found", F.array().cast("array<bigint>"))
        )

    def _hashes(self, used: Column, whole: Column) -> Column:
        """The hash of the terms in each lexicon; one expression serves them all."""
        lexicons = F.array(
            *[
                F.struct(
                    F.lit((1 << bits) - 1).cast("long").alias("mask"),
                    F.lit(self.seed + i).alias("seed"),
                    F.lit(i).alias("i"),
                )
                for i, bits in enumerate(self.lexicon_bits)
            ]
        )

        def one(lexicon: Column) -> Column:
            def member(term: Column) -> Column:
                return F.xxhash64(term, lexicon["seed"]).bitwiseAND(lexicon["mask"]) == 0

            # An array of one binds the terms, or they would be filtered twice
            return F.transform(
                F.array(F.filter(used, member)),
                lambda held: F.when(F.size(held) > 0, F.xxhash64(held)).otherwise(
                    F.xxhash64(whole, lexicon["i"])
                ),
            )[0]

        return F.transform(lexicons, one)

    def columns(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """The rows with ``out``: the series' hashes as an array of longs."""
        looked_up = df if self.in_plan else self._joined(df, text, out)
        found = looked_up.withColumn(f"{out}_all", terms(F.col(text)))
        if self.in_plan:
            found = found.withColumn(f"{out}_band", self._in_band(F.col(f"{out}_all")))
        used = found.withColumn(
            f"{out}_used",
            F.sort_array(
                F.when(F.size(f"{out}_band") > 0, F.col(f"{out}_band"))
                .when(F.size(f"{out}_all") > 0, F.col(f"{out}_all"))
                .otherwise(F.array(F.xxhash64(F.col(text), F.lit("no words"))))
            ),
        )

        used = used.withColumn(f"{out}_whole", F.xxhash64(f"{out}_used"))
        hashes = self._hashes(F.col(f"{out}_used"), F.col(f"{out}_whole"))
        return used.withColumn(out, hashes).select(*df.columns, out)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the lexicons on which two fingerprints agree."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda s, x: s + x) / F.size(a).cast("double")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below the key, by binary search; -1 for null."""
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = F.array(*[F.lit(2**i) for i in reversed(range(max(1, len(bounds).bit_length())))])
    count = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(table, at + step - 1) <= key, F.lit(False)), at + step
        ).otherwise(at),
    )
    return F.when(key.isNull(), F.lit(-1)).otherwise(count)


def with_next(docs: DataFrame, key: str, text: str, ranges: int = NEIGHBOUR_RANGES) -> DataFrame:
    """id, text, part, ghost: rows dealt by ranges of ids, each range followed by the next's first.

    Ranges hold about as many ids each.  The first document of a range, in
    descending order, is repeated (a ghost) behind the range before it, and the
    first of all behind the last, so that within a range every row but the
    ghost has its neighbour.
    """
    ids = docs.select(F.col(key).cast("long").alias("id"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = ids.agg(F.percentile_approx("id", shares, 100 * ranges)).first()[0] or []
    part = _range_of(F.col("id"), sorted(set(cuts)))
    # One row a range
    tops = ids.withColumn("part", part).groupBy("part").agg(F.max("id").alias("top")).collect()
    tops = sorted(((r["part"], r["top"]) for r in tops), reverse=True)
    ghosts = [
        (here, top, tops[i - 1][0]) for i, (here, top) in enumerate(tops)
    ]
    heads = docs.sparkSession.range(1).select(
        F.inline(
            F.from_json(
                F.lit(json.dumps([{"p": p, "top": t, "behind": b} for p, t, b in ghosts])),
                "array<struct<p:int,top:bigint,behind:int>>",
            )
        )
    )
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("part", part)
    # At most a row a range
    marked = rows.join(
        F.broadcast(heads), (F.col("part") == F.col("p")) & F.col("id").eqNullSafe(F.col("top")), "left"
    )
    places = F.when(F.col("behind").isNull(), F.array(F.struct("part", F.lit(0).alias("ghost"))))
    both = F.array(
        F.struct("part", F.lit(0).alias("ghost")),
        F.struct(F.col("behind").alias("part"), F.lit(1).alias("ghost")),
    )
    return marked.select("id", "text", F.inline(places.otherwise(both)))


def fingerprint_edits(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    common: float = COMMON,
    rare: float = RARE,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has its last half replaced by as much of the next document,
    in descending order of ids.
    """
    make = Fingerprinter(band(docs, text, common, rare), most_terms)
    order = Window.partitionBy("part").orderBy(
        "ghost", F.col("id").desc_nulls_last(), F.col("text")
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (
        with_next(docs, key, text)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn(
            "edited",
            F.concat(
                F.left("text", (F.col("n_chars") - half).cast("int")),
                F.left(F.coalesce("next_text", F.lit("")), half),
            ),
        )
        .drop("next_text")
    )
    if not make.in_plan:
        rows = stage(rows)  # read by the lookups of both texts and by what they join
    printed = make.columns(make.columns(rows, "text", "print"), "edited", "edited_print")
    return (
        printed.withColumn("next_print", F.lead("print").over(order))
        .where("ghost = 0")
        .select(
            F.col("id").alias(key),
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            as_text(F.col("print")).alias("fingerprint"),
            as_text(F.col("edited_print")).alias("edited_fingerprint"),
            likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
            likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        )
    )
