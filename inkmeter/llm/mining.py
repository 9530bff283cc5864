"""Hard negatives of anchor vectors, by angular triangle filtering.

Vectors become integers, ``floor(scale * x)``, and a score is their integer
inner product.  Each vector is stored with its angles to a few reference
directions (rows of the table, chosen by hash).  The angle between an anchor
and a row lies between the difference and the sum of their angles to any
reference, which gives a cosine interval; the intervals of all references
intersect, and times both norms, rounded outwards by more than any error of
the arithmetic, they bound the score.  Only rows whose bounds reach into the
window that is asked for are scored.

Anchors are a stated query set.  They meet all rows in blocks: rows and anchors
are dealt by hash into blocks of bounded bytes, a task takes one pair of blocks
and keeps its best few rows for each anchor, and a ranking over blocks keeps
the best of those.  A label may hold any share of the rows; blocks do not
follow labels.

Cases: rows with a null label, a null vector or a null or non-finite component
take no part, nor do those whose integer squared norm reaches 2**62, whose
scores need not fit a long; shorter vectors count as padded with zeros.  A null
id comes last in ties and is no anchor; repeated rows take part each, also as
anchors.  An anchor without positives, or a window without rows, gives no
rows, as does an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, OF = 30, 90, 100  # the window in shares of the positive's score
REFERENCES = 12
LARGEST = 2.0**62
EXACT = 2.0**53
BLOCK_VALUES = 1 << 21  # components in a block
LEAST_ROWS = 1024
#: Angles come from arc cosines, which are good to about 3e-8 near their ends
SLACK = 1e-6

ROW = "row long, id long, label string, anchor boolean, q array<long>, angles array<double>"


def _matrix(lists: pa.Array, width: int | None = None, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    width = max(int(sizes.max(initial=0)), width or 0)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=kind)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def usable(
    vectors: DataFrame, anchor: Column, ident: str, label: str, vector: str, scale: float
) -> DataFrame:
    """id, label, anchor, q: the rows that take part, with whole components."""

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            with np.errstate(over="ignore", invalid="ignore"):
                # a null component arrives as not a number
                x = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
                row = np.repeat(np.arange(len(sizes)), sizes)
                squares = np.bincount(row, x * x, minlength=len(sizes))
            good = squares < LARGEST
            kept = np.flatnonzero(good)
            ends = np.append(0, np.cumsum(sizes[kept])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).take(pa.array(kept)) for k in range(3)),
                    pa.ListArray.from_arrays(ends, x[good[row]].astype(np.int64)),
                ],
                ["id", "label", "anchor", "q"],
            )

    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(ident).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("x"),
    )
    return rows.mapInArrow(quantised, "id long, label string, anchor boolean, q array<long>")


def with_angles(rows: DataFrame, references: int = REFERENCES) -> DataFrame:
    """The rows with an identity of their own and angles to the reference directions, staged."""
    chosen = rows.orderBy(F.xxhash64("id", "label"), F.xxhash64("q")).limit(references).collect()
    width = max((len(r["q"]) for r in chosen), default=0)
    units = [
        np.pad(v, (0, width - len(v))) / n
        for v in (np.asarray(r["q"], dtype=float) for r in chosen)
        if (n := np.linalg.norm(v)) > 0
    ]
    reference = np.array(units).reshape(len(units), width)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(4), width)
            norm = np.linalg.norm(q, axis=1)
            wide = np.zeros((len(reference), q.shape[1]))
            wide[:, :width] = reference
            cosine = q @ wide.T / np.where(norm > 0, norm, 1)[:, None]
            angle = np.arccos(np.clip(cosine, -1, 1))
            ends = np.arange(len(q) + 1, dtype=np.int32) * len(reference)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, angle.ravel())],
                [*batch.schema.names, "angles"],
            )

    named = rows.select(F.monotonically_increasing_id().alias("row"), "*")
    return stage(named.mapInArrow(measured, ROW))


class Block:
    """Rows of a block in order of label, then id, ready for bounds and scores."""

    def __init__(self, rows: pa.Table, width: int) -> None:
        ident, self.row = rows["id"].to_pandas(), rows["row"].to_numpy()
        label = rows["label"].to_numpy().astype(str)
        order = np.lexsort((self.row, ident.fillna(0), ident.isna(), label))
        rows = rows.take(pa.array(order))
        self.row, self.label = self.row[order], label[order]
        self.id = rows["id"].combine_chunks()
        ident = ident.iloc[order]
        self.place = np.empty(len(order), dtype=np.int64)  # among equal scores
        self.place[np.lexsort((self.row, ident.fillna(0), ident.isna()))] = np.arange(len(order))
        self.q = _matrix(rows["q"], width, np.int64)
        self.norm = np.linalg.norm(self.q.astype(float), axis=1)
        self.small = self.norm.max(initial=0)
        angles = _matrix(rows["angles"]).T
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        self.exact = self.q.astype(float)

    def bounds(self, anchor: Anchor, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers that no score of the rows of a part lies below or above."""
        size = anchor.norm * self.norm[part]
        if not len(self.cos):
            least, most = -np.ones(len(size)), np.ones(len(size))
        else:
            middle = anchor.cos[:, None] * self.cos[:, part]
            swing = anchor.sin[:, None] * self.sin[:, part]
            least, most = (middle - swing).max(axis=0), (middle + swing).min(axis=0)
        return (
            np.floor(size * (least - SLACK)) - 1,
            np.ceil(size * (most + SLACK)) + 1,
        )

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        if anchor.norm * self.small < EXACT:  # sums of whole numbers, exact in any order
            return (self.exact[rows] @ anchor.q.astype(float)).astype(np.int64)
        return self.q[rows] @ anchor.q

    def best(self, rows: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Places in ``rows`` of the n best: higher scores first, then smaller ids."""
        if len(rows) > n:
            bar = np.partition(scores, len(rows) - n)[len(rows) - n]
            above = np.flatnonzero(scores > bar)
            tied = np.flatnonzero(scores == bar)
            need = n - len(above)
            if len(tied) > need:
                places = self.place[rows[tied]]
                tied = tied[np.argpartition(places, need - 1)[:need]]
            near = np.append(above, tied)
        else:
            near = np.arange(len(rows))
        return near[np.lexsort((self.place[rows[near]], -scores[near]))]


class Anchor:
    def __init__(self, row: int, label: str, q: np.ndarray, angles: np.ndarray) -> None:
        self.row, self.label, self.q = row, label, q
        self.norm = float(np.linalg.norm(q.astype(float)))
        self.cos, self.sin = np.cos(angles), np.sin(angles)


def _anchors(rows: pa.Table, width: int) -> Iterator[Anchor]:
    q, angles = _matrix(rows["q"], width, np.int64), _matrix(rows["angles"])
    labels, names = rows["label"].to_pylist(), rows["row"].to_numpy()
    for k in range(rows.num_rows):
        yield Anchor(int(names[k]), labels[k], q[k], angles[k])


def _width(*tables: pa.Table) -> int:
    return max(
        int(np.diff(t["q"].combine_chunks().offsets.to_numpy()).max(initial=0))
        for t in tables
    )


def _found(found: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*found, strict=True)) or [[] for _ in kinds]
    arrays = [
        pa.concat_arrays(c) if c and isinstance(c[0], pa.Array) else
        (pa.array(np.concatenate(c)) if c else pa.array([], k)).cast(k)
        for c, k in zip(columns, kinds.values(), strict=True)
    ]
    return pa.Table.from_arrays(arrays, names=list(kinds))


PAIR = {"anchor_row": pa.int64(), "row": pa.int64(), "id": pa.int64(), "score": pa.int64()}


def _positives(n: int):  # noqa: ANN202
    def of_block(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            width = _width(rows, anchors)
            block = Block(rows, width)
            for anchor in _anchors(anchors, width):
                begin = int(np.searchsorted(block.label, anchor.label, "left"))
                end = int(np.searchsorted(block.label, anchor.label, "right"))
                least, most = block.bounds(anchor, slice(begin, end))
                other = block.row[begin:end] != anchor.row
                if other.sum() > n:  # n rows reach this score for certain
                    sure = least[other]
                    other &= most >= np.partition(sure, len(sure) - n)[len(sure) - n]
                near = np.flatnonzero(other) + begin
                if len(near):
                    scores = block.scores(anchor, near)
                    top = block.best(near, scores, n)
                    found.append(_pairs(anchor, block, near[top], scores[top]))
        return _found(found, PAIR)

    return of_block


def _pairs(anchor: Anchor, block: Block, rows: np.ndarray, scores: np.ndarray) -> tuple:
    return (
        np.full(len(rows), anchor.row),
        block.row[rows],
        block.id.take(pa.array(rows)),
        scores,
    )


NEGATIVE = {"anchor_row": pa.int64(), "positive_place": pa.int32()} | {
    k: PAIR[k] for k in ("row", "id", "score")
}


def _negatives(n: int, low: int, high: int, of: int):  # noqa: ANN202
    def of_block(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            width = _width(rows, anchors)
            block = Block(rows, width)
            asked = anchors["scores"].to_pylist()
            for anchor, scores in zip(_anchors(anchors, width), asked, strict=True):
                found += _windows(block, anchor, scores, n, low, high, of)
        return _found(found, NEGATIVE)

    return of_block


def _windows(
    block: Block, anchor: Anchor, positives: list[int], n: int, low: int, high: int, of: int
) -> list[tuple]:
    least, most = block.bounds(anchor, slice(None))
    other = block.label != anchor.label
    windows = [(-(-low * p // of), high * p // of) for p in positives]
    reach = []
    for floor, roof in windows:
        overlaps = other & (most >= floor) & (least <= roof)
        sure = least[overlaps & (least >= floor) & (most <= roof)]
        if len(sure) > n:  # n rows of the window reach this score for certain
            overlaps &= most >= np.partition(sure, len(sure) - n)[len(sure) - n]
        reach.append(overlaps)
    near = np.flatnonzero(np.logical_or.reduce(reach)) if reach else np.zeros(0, dtype=int)
    if not len(near):
        return []
    scores = block.scores(anchor, near)
    out = []
    for place, ((floor, roof), overlaps) in enumerate(zip(windows, reach, strict=True)):
        inside = np.flatnonzero(overlaps[near] & (scores >= floor) & (scores <= roof))
        if len(inside):
            top = inside[block.best(near[inside], scores[inside], n)]
            row, *rest = _pairs(anchor, block, near[top], scores[top])
            out.append((row, np.full(len(top), place, dtype=np.int32), *rest))
    return out


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(
        F.desc("score"), F.asc_nulls_last("id"), F.asc("row")
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


class _Blocks:
    """Rows and anchors dealt into pairs of blocks."""

    def __init__(self, rows: DataFrame) -> None:
        spark = rows.sparkSession
        counts = rows.agg(
            F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("q"))
        ).first()
        size = max(BLOCK_VALUES // max(counts[2] or 1, 1), 1)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.blocks = max(-(-counts[0] // size), min(tasks, -(-counts[0] // LEAST_ROWS)), 1)
        self.chunks = max(-(-counts[1] * 2 // size), 1)
        self.rows = rows.select(
            F.pmod(F.xxhash64("row"), F.lit(self.blocks)).cast("long").alias("block"),
            F.explode(_upto(self.chunks)).alias("chunk"),
            "row", "id", "label", "q", "angles",
        )

    def meet(self, anchors: DataFrame, work, kinds: dict[str, pa.DataType]) -> DataFrame:  # noqa: ANN001
        dealt = anchors.select(
            F.explode(_upto(self.blocks)).alias("block"),
            F.pmod(F.xxhash64("row"), F.lit(self.chunks)).cast("long").alias("chunk"),
            *anchors.columns,
        )
        names = {pa.int64(): "long", pa.int32(): "int"}
        schema = ", ".join(f"{k} {names[v]}" for k, v in kinds.items())
        return (
            self.rows.groupBy("block", "chunk")
            .cogroup(dealt.groupBy("block", "chunk"))
            .applyInArrow(work, schema)
        )


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    ident: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int, int] = (LOW, HIGH, OF),
    references: int = REFERENCES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A positive is one of an anchor's best ``positives`` other rows of its label;
    its negatives are the best rows of other labels whose score lies between
    ``low / of`` and ``high / of`` of the positive's.
    """
    rows = with_angles(usable(vectors, anchor, ident, label, vector, scale), references)
    blocks = _Blocks(rows)
    asked = rows.where("anchor").select("row", "id", "label", "q", "angles")
    met = blocks.meet(asked.drop("id"), _positives(positives), PAIR)
    chosen = stage(_best(met, ["anchor_row"], positives))
    pairs = chosen.groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("pairs")
    )
    asked = stage(
        asked.join(pairs.withColumnRenamed("anchor_row", "row"), "row").select(
            "row", "id", "label", "q", "angles", "pairs", F.col("pairs.score").alias("scores")
        )
    )
    met = blocks.meet(
        asked.drop("id", "pairs"), _negatives(negatives, *window), NEGATIVE
    )
    best = _best(met, ["anchor_row", "positive_place"], negatives)
    named = asked.select(
        F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"), "pairs"
    )
    return best.join(named, "anchor_row").select(
        "anchor_id",
        F.get("pairs", F.col("positive_place"))["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.get("pairs", F.col("positive_place"))["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
