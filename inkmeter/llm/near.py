"""Near duplicates: MinHash banding, signature check, full sets, components.

1. One pass turns every text into its set of word shingles and keeps the
   minima of many universal hash functions, and one key for each band of them.
   Texts of one set form a class; from here on a class is one node, however
   many documents it has.
2. Nodes that share a band key form a bucket.  Within a bucket signatures are
   compared, and of the likely pairs only a spanning forest is emitted: what is
   needed is which nodes may belong together, not every pair.  Components of
   these edges are families.
3. Texts of families are read again, found through a Bloom filter of their ids,
   and links are confirmed on full sets, again emitting a spanning forest.
4. Components of confirmed links are the result.

Large buckets and families are cut into blocks by a node's hash, and each pair
of blocks is a task's unit (a tile) of bounded rows and bytes, so no group has
to fit into a task.  Comparing signatures within a family of different texts
stays quadratic in that family; nothing else is.

Two texts at the threshold share no band with a probability of about 5e-6 and
fall below the signature margin with about 3e-6; links of higher likeness are
missed more rarely still.

Cases: null text is empty; a text without words has an empty set and links
with nothing; a text of fewer words than a shingle has one shingle, the whole
sequence.  Null ids count as unknown and are never the smallest.  Repeated
rows are copies of one class.  An empty table gives an empty result.  Further
columns are never looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.bloom import filter_bits, set_bits, with_possible
from inkmeter.llm.components import components
from inkmeter.llm.runs import whole_runs
from inkmeter.llm.shingles import PIECE, feature_batches, row_sums, shingle_sets
from inkmeter.llm.staging import stage
from inkmeter.llm.wordhash import mix, pieces

WIDTH = 5
PERCENT = 75
HASHES = 128
BAND_ROWS = 4
SEED = 7
# 4.5 standard deviations of the estimate below the threshold
MARGIN = 0.17
BLOCK_NODES = 1024
BLOCK_BYTES = 8 << 20


class Forest:
    """Union-find over the rows of a tile."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[x] = y
        return x != y


def _signatures(rows: pa.Table) -> np.ndarray:
    data = b"".join(rows["signature"].to_pylist())
    return np.frombuffer(data, dtype=np.uint16).reshape(rows.num_rows, -1)


def _links(pairs: list[tuple[int, int]], node: np.ndarray) -> pa.RecordBatch:
    ends = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch(
        [pa.array(node[ends[:, 0]]), pa.array(node[ends[:, 1]])], ["a", "b"]
    )


def likely_links(
    batches: Iterator[pa.RecordBatch], keys: list[str], least: float
) -> Iterator[pa.RecordBatch]:
    """For each tile, a spanning forest of the pairs whose signatures agree enough."""
    for rows, bounds in whole_runs(batches, keys):
        if not rows.num_rows:
            continue
        signature, node = _signatures(rows), rows["node"].to_numpy()
        counts = np.diff(bounds)
        first = np.repeat(bounds[:-1], counts)
        near = np.zeros(rows.num_rows, dtype=bool)
        for at in range(0, rows.num_rows, 1 << 14):
            part = slice(at, at + (1 << 14))
            near[part] = (signature[part] == signature[first[part]]).mean(axis=1) >= least
        pairs = [(int(x), int(first[x])) for x in np.flatnonzero(near & (node != node[first]))]
        far = np.add.reduceat(~near, bounds[:-1])
        for run in np.flatnonzero((far > 0) & (counts > 2)):
            begin, end = bounds[run], bounds[run + 1]
            forest, inside = Forest(end - begin), signature[begin:end]
            for x in np.flatnonzero(near[begin:end]):
                forest.join(int(x), 0)
            for x in np.flatnonzero(~near[begin:end]).tolist():
                like = (inside == inside[x]).mean(axis=1) >= least
                for y in np.flatnonzero(like).tolist():
                    if forest.join(x, y):
                        pairs.append((int(begin + x), int(begin + y)))
        yield _links(pairs, node)


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed_links(
    batches: Iterator[pa.RecordBatch], keys: list[str], least: float, percent: int
) -> Iterator[pa.RecordBatch]:
    """For each tile, a spanning forest of the pairs that are similar on full sets."""
    for rows, bounds in whole_runs(batches, keys):
        if not rows.num_rows:
            continue
        signature, node = _signatures(rows), rows["node"].to_numpy()
        sets = rows["shingles"].combine_chunks()
        pairs: list[tuple[int, int]] = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            inside = signature[begin:end]
            forest = Forest(end - begin)
            full = [np.frombuffer(sets[i].as_buffer(), dtype=np.uint64) for i in range(begin, end)]
            left, right, like = [], [], []
            for x in range(1, end - begin):
                alike = (inside[:x] == inside[x]).mean(axis=1)
                found = np.flatnonzero(alike >= least)
                left.append(np.full(len(found), x))
                right.append(found)
                like.append(alike[found])
            if not left:
                continue
            x, y, like = (np.concatenate(part) for part in (left, right, like))
            order = np.argsort(-like, kind="stable")  # links come early and spare later checks
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                if forest.find(i) != forest.find(j) and _similar(full[i], full[j], percent):
                    forest.join(i, j)
                    pairs.append((begin + i, begin + j))
        yield _links(pairs, node)


def set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """id, text -> id, node, shingles (sorted distinct hashes, 8 bytes each)."""
    for whole in batches:
        for batch in pieces(pa.record_batch([whole["text"], whole["id"]], ["text", "id"]), PIECE):
            sets, bounds = shingle_sets(batch.column(0), width)
            node = mix(row_sums(mix(sets + np.uint64(1)), bounds)).view(np.int64)
            data = sets.tobytes()
            yield pa.record_batch(
                [
                    batch.column(1),
                    pa.array(node),
                    pa.array(
                        [data[8 * b : 8 * e] for b, e in zip(bounds[:-1], bounds[1:], strict=True)],
                        pa.binary(),
                    ),
                ],
                ["id", "node", "shingles"],
            )


def _tiles(rows: DataFrame, group: str) -> DataFrame:
    """Rows of (group, node, blocks, ...) dealt to pairs of blocks, sorted by them."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        rows.withColumn("block", block)
        .withColumn("other", other)
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("block", "other", "blocks")
        .repartition(group, "low", "high")
        .sortWithinPartitions(group, "low", "high")
    )


class NearDuplicates:
    """Classes, links and components of one table's texts."""

    def __init__(
        self,
        docs: DataFrame,
        key: str = "doc_id",
        text: str = "text",
        width: int = WIDTH,
        percent: int = PERCENT,
        hashes: int = HASHES,
        band_rows: int = BAND_ROWS,
        seed: int = SEED,
    ) -> None:
        rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
        self.features = stage(
            rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
                lambda b: feature_batches(b, width, hashes, band_rows, seed),
                "id long, text_hash long, n_shingles long, node long, signature binary, "
                "bands array<long>",
            )
        )
        least = percent / 100 - MARGIN
        full = self.features.where("n_shingles > 0")
        self.classes = stage(full.groupBy("node").agg(F.min("id").alias("rep")))
        nodes = stage(
            full.join(self.classes, "node")
            .where("id <=> rep")
            .dropDuplicates(["node"])
            .select("node", "rep", "n_shingles", "signature", "bands")
        )
        self.families = stage(self._families(nodes, least))
        links = stage(self._links(rows, nodes, width, least, percent))
        self.roots = stage(components(links))

    @staticmethod
    def _families(nodes: DataFrame, least: float) -> DataFrame:
        """node, root of the nodes that may be linked with another."""
        band = nodes.select("node", F.explode("bands").alias("bucket"))
        shared = (
            band.groupBy("bucket")
            .agg(F.count("*").alias("size"))
            .where("size > 1")
            .select("bucket", F.ceil(F.col("size") / BLOCK_NODES).alias("blocks"))
        )
        members = stage(band.join(shared, "bucket"))
        signed = members.join(nodes.select("node", "signature"), "node")
        keys = ["bucket", "low", "high"]
        likely = _tiles(signed, "bucket").mapInArrow(
            lambda b: likely_links(b, keys, least), "a long, b long"
        )
        return components(likely)

    def _links(
        self, rows: DataFrame, nodes: DataFrame, width: int, least: float, percent: int
    ) -> DataFrame:
        """A spanning forest of the links confirmed on full sets."""
        family = self.families.join(nodes.drop("bands"), "node")
        blocks = family.groupBy("root").agg(
            F.greatest(
                F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES)
            ).alias("blocks")
        )
        wanted = stage(
            family.join(blocks, "root").select("node", "rep", "root", "blocks", "signature")
        )
        bits = filter_bits(wanted.count())
        words = stage(set_bits(wanted.select(F.col("rep").alias("id")), ["id"], bits))
        sets = (
            with_possible(rows, ["id"], words, bits)
            .where("possible")
            .select("id", "text")
            .mapInArrow(lambda b: set_batches(b, width), "id long, node long, shingles binary")
        )
        full = sets.join(wanted, "node").where("id <=> rep").drop("id", "rep")
        keys = ["root", "low", "high"]
        return _tiles(full, "root").mapInArrow(
            lambda b: confirmed_links(b, keys, least, percent), "a long, b long"
        )

    def labels(self) -> DataFrame:
        """node, component_id, root: the smallest id of each node's component."""
        rooted = self.classes.join(self.roots, "node", "left").select(
            "node", "rep", F.coalesce("root", "node").alias("root")
        )
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        return stage(rooted.join(least, "root").select("node", "component_id", "root"))


def mark_near(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """One row per document: key, n_shingles, component_id, kept."""
    found = NearDuplicates(docs, key, text, **options)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (
        found.features.select("id", "n_shingles", "node")
        .join(found.labels(), "node", "left")
        .select(
            F.col("id").alias(key),
            "n_shingles",
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )


def keep_near(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """The document of the smallest id of each component, with the columns it came with.

    Only rows whose id may be one that goes are looked at again; the others
    pass straight through.  Repeated rows of a document that stays all stay.
    """
    found = NearDuplicates(docs, key, text, **options)
    gone = stage(
        found.features.where("n_shingles > 0")
        .select("id", "text_hash", "node")
        .join(found.labels(), "node")
        .where("NOT id <=> component_id")
        .groupBy("id", "text_hash")
        .agg(F.lit(True).alias("gone"))
    )
    bits = filter_bits(gone.count())
    names = ["id", "text_hash"]
    words = stage(set_bits(gone, names, bits))
    rows = with_possible(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            F.col(key).cast("long").alias("id"),
            F.xxhash64(F.col(text)).alias("text_hash"),
        ),
        names,
        words,
        bits,
    )
    maybe, other = rows.where("possible").alias("maybe"), gone.alias("other")
    same = F.col("maybe.id").eqNullSafe(F.col("other.id")) & (
        F.col("maybe.text_hash") == F.col("other.text_hash")
    )
    kept = maybe.join(other, same, "left_anti").select("row")
    return rows.where("NOT possible").select("row").union(kept).select("row.*")
