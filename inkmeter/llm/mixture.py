"""Mixing sources to target weights by fitting a budget of words.

Each source's budget is filled with whole documents.  Documents are counted by
source and exact length; on those counts, never on documents, a source's
budget is fitted: as many rounds of all its documents as fit, then the same
share of every length, then longer lengths first until little is left, and for
that rest a bounded-knapsack program over the remaining counts finds the
fullest sum.  Which documents of a length are taken is decided by a seeded hash
of the row: lengths are cut into cells by that hash, whole cells are taken in
order, and only within the one cell where the number runs out are rows ranked.
So no source and no length is ever ranked as a whole.

Targets: sources in code point order, null last, have the given weights in
turn and share ``budget`` times all words; a target stops at ``repeats`` times
its source's words, and the excess is shared again by weight until none is
above.

Cases: null text has no words and is never taken; null is a source like any
other.  Repeated rows are rows of their own.  Ties of the hash are broken by
id.  An empty table, or one without words, gives rows with nothing taken.
Further columns are never looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter.llm.staging import numbered, stage

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
REPEATS = 2
SEED = 11
CELLS = 256
KNAPSACK_WORDS = 1 << 15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float], budget: float, repeats: int
) -> DataFrame:
    """source, source_size -> source, source_size, target."""
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.col("position") - 1) % len(weights) + 1).cast("int"),
    )
    weighed = stage(
        numbered(sizes, F.col("source").asc_nulls_last()).select(
            "source",
            "source_size",
            turn.alias("weight"),
            (F.lit(float(repeats)) * F.col("source_size")).alias("most"),
        )
    )
    total = budget * float(weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("weight") * level > F.col("most")
        used, open_weight = weighed.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)),
        ).first()
        if not open_weight:
            break
        raised = (total - used) / open_weight
        if raised <= level:
            break
        level = raised
    return weighed.select(
        "source",
        "source_size",
        F.least(F.col("most"), F.col("weight") * level).alias("target"),
    )


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, once each, to fill the budget best."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.array(
        [int(c) * budget // total for c in counts.tolist()], dtype=np.int64
    )
    left = budget - int((lengths * taken).sum())
    window = min(8 * int(lengths.max()), KNAPSACK_WORDS)
    order = np.argsort(-lengths, kind="stable")
    for i in order.tolist():
        more = min(int(counts[i] - taken[i]), max(0, left - window) // int(lengths[i]))
        taken[i] += more
        left -= more * int(lengths[i])
    # Long ones are given back until the program below has enough to choose from
    for i in order.tolist():
        back = min(int(taken[i]), -(-max(0, window - left) // int(lengths[i])))
        taken[i] -= back
        left += back * int(lengths[i])
    # Sums the remaining documents can reach, a bit each; items are powers of two of a length
    inside = (1 << (left + 1)) - 1
    reach, steps = 1, []
    for i in order.tolist():
        spare, block = min(int(counts[i] - taken[i]), left // int(lengths[i])), 1
        while spare > 0:
            number = min(block, spare)
            steps.append((i, number, reach))
            reach |= (reach << (number * int(lengths[i]))) & inside
            spare -= number
            block *= 2
        if reach >> left & 1:
            break
    best = reach.bit_length() - 1
    for i, number, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += number
            best -= number * int(lengths[i])
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    size, budget = int(rows["source_size"].iloc[0]), int(rows["budget"].iloc[0])
    rounds = budget // size
    lengths, counts = rows["size"].to_numpy(np.int64), rows["rows"].to_numpy(np.int64)
    extra = fit(lengths, counts, budget - rounds * size)
    return pd.DataFrame(
        {"source": rows["source"], "size": lengths, "rounds": rounds, "extra": extra}
    )


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def _rows(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("draw"),
    )


def allot(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, draw, size, source_size, target, times."""
    rows = stage(_rows(docs, key, text, source, seed))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stage(targets(sizes, weights, budget, repeats))
    cell = F.pmod("draw", F.lit(CELLS)).alias("cell")
    cells = stage(
        rows.where("size > 0")
        .select("source", "size", cell)
        .groupBy("source", "size", "cell")
        .agg(F.count("*").alias("rows"))
    )
    counted = cells.groupBy("source", "size").agg(F.sum("rows").alias("rows"))
    plan = stage(
        counted.alias("c")
        .join(goal.alias("g"), _same("c", "g", ["source"]))
        .select("c.*", "source_size", F.floor("target").alias("budget"))
        .groupBy("source")
        .applyInPandas(_fit_source, "source string, size long, rounds long, extra long")
    )
    # At most CELLS rows of a source and length meet in one window
    ahead = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    quota = stage(
        cells.alias("c")
        .join(plan.alias("p"), _same("c", "p", ["source", "size"]))
        .select("c.*", "rounds", "extra")
        .withColumn("before", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
        .withColumn(
            "quota", F.greatest(F.lit(0), F.least(F.col("extra") - F.col("before"), F.col("rows")))
        )
        .select("source", "size", "cell", "rows", "rounds", "quota")
    )
    names = ["source", "size", "cell"]
    dealt = (
        rows.select("*", cell)
        .alias("r")
        .join(quota.alias("q"), _same("r", "q", names), "left")
        .select("r.*", "rows", "rounds", "quota")
    )
    torn = (F.col("quota") > 0) & (F.col("quota") < F.col("rows"))
    whole = dealt.where(~torn | F.col("quota").isNull()).withColumn(
        "times",
        F.coalesce(F.col("rounds") + F.when(F.col("quota") > 0, 1).otherwise(0), F.lit(0)),
    )
    rank = F.row_number().over(Window.partitionBy(*names).orderBy("draw", "id"))
    part = dealt.where(torn).withColumn(
        "times", F.col("rounds") + F.when(rank <= F.col("quota"), 1).otherwise(0)
    )
    both = whole.unionByName(part)
    return (
        both.alias("b")
        .join(goal.alias("g"), _same("b", "g", ["source"]))
        .select("id", "draw", "size", "source_size", "target", F.col("times").cast("long").alias("times"))
    )


def mark_mix(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:  # noqa: ANN003
    """One row per document: key, size, source_size, target, taken."""
    return allot(docs, key, **options).select(
        F.col("id").alias(key),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def take_mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
    **options,  # noqa: ANN003
) -> DataFrame:
    """The documents of the mix with the columns they came with, as often as they are taken."""
    times = allot(docs, key, text, source, seed=seed, **options)
    each = (
        times.groupBy("id", "draw")
        .agg(F.sum("times").alias("times"), F.count("*").alias("rows"))
        .where("times > 0")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(key).alias("id"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("draw"),
    )
    found = rows.alias("r").join(each.alias("e"), _same("r", "e", ["id", "draw"])).select(
        "row", "r.id", "r.draw", "times", "rows"
    )
    # Repeated rows share what they were given, the first ones one more
    turn = F.row_number().over(Window.partitionBy("id", "draw").orderBy("draw")) - 1
    share = F.floor((F.col("times") - turn + F.col("rows") - 1) / F.col("rows"))
    alone = found.where("rows = 1").select("row", "times")
    shared = found.where("rows > 1").withColumn("share", share).select("row", F.col("share").alias("times"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return alone.union(shared).where("times > 0").select("row", copy.alias("copy")).select("row.*")
