"""Language of a text, by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to four bytes, counted in
labelled texts.  A byte is coded in the longest context the tree holds; where
the byte was never seen there, the escape of method C is paid and the next
shorter context tried, with the bytes of the longer one excluded, down to an
even share of all bytes.  Counts are frozen, so a byte's code length depends on
the four bytes before it and itself only: each distinct group of five is worked
out once a slice, for all languages, and documents add the results up.  The
language of least code length is the prediction, its posterior under equal
priors the score.

What is fitted is bounded, whatever the size of the input: ``SAMPLE_ROWS``
whole documents a language, those of the smallest hashed id, and ``MOST_NODES``
counts in all; where the sample holds more, the least frequent ones of every
order go together.  A task builds each tree; the trees go to the driver and are
broadcast.  Rows outside the sample move nowhere.  Everything else covers all
rows.

Cases: a null text, or one without a letter, is ``und`` with score 0, as is
every text if nothing could be learned; an empty language value is a value; a
null id counts as empty text and is held out; equal code lengths go to the
smaller name in code-point order; repeated rows are predicted each; an empty
table gives no rows; other columns are not read.  Texts are walked in slices of
``SLICE`` bytes, so memory does not follow the longest.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage
from inkmeter.llm.wordhash import FOLD, pieces, string_bytes

ORDER = 4
BITS = 9
START = 256  # stands before the first byte of a text
SLICE = 1 << 21
SAMPLE_ROWS = 4096
MOST_NODES = 1 << 21
TOP_COUNT = 1 << 12  # counts above it are never dropped
UNKNOWN = "und"


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is never learned from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def _mask(symbols: int) -> np.uint64:
    return np.uint64((1 << (BITS * symbols)) - 1)


def codes(column: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Slices of a column's bytes: five-symbol codes, the slice's begin, row bounds."""
    data, bounds = string_bytes(column)
    data = FOLD[data]
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    for begin in range(0, len(data), SLICE):
        end = min(begin + SLICE, len(data))
        code = data[begin:end].astype(np.uint64)
        for back in range(1, ORDER + 1):
            earlier = np.full(end - begin, START, dtype=np.uint64)
            lag = max(0, back - begin)
            earlier[lag:] = data[begin - back + lag : end - back]
            code |= earlier << np.uint64(BITS * back)
        for into in range(ORDER):  # contexts do not reach over a text's beginning
            at = starts + into
            at = at[(at >= begin) & (at < end)]
            at = at[bounds[np.searchsorted(bounds, at, side="right") - 1] + into == at] - begin
            fill = sum(START << (BITS * back) for back in range(into + 1, ORDER + 1))
            code[at] = (code[at] & _mask(into + 1)) | np.uint64(fill)
        yield code, begin, bounds


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, code, n of each slice; codes keep their bits as signed numbers."""
    for batch in batches:
        for piece in pieces(batch):
            langs = np.asarray(piece.column(1).to_pylist(), dtype=object)
            for code, begin, bounds in codes(piece.column(0)):
                row = np.searchsorted(bounds, np.arange(begin, begin + len(code)), "right") - 1
                names, lang = np.unique(langs[row].astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    found, n = np.unique(code[lang == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(found), pa.string()),
                            pa.array(found.view(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        ["lang", "code", "n"],
                    )


def sample(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 5,
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """text, lang of at most ``rows`` documents a language outside the held-out fold."""
    learned = docs.where(
        ~held_out(F.col(doc_id), folds) & F.col(lang).isNotNull() & F.col(text).isNotNull()
    ).select(
        F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(doc_id)).alias("place"),
    )
    # A share of each language that holds its sample by a wide margin; the rest stays put
    sizes = stage(learned.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang")))
    share = F.pmod(F.col("place"), F.lit(1 << 30)) * F.col("of_lang") / float(1 << 30)
    ranks = Window.partitionBy("lang").orderBy(
        F.pmod(F.col("place"), F.lit(1 << 30)), "place", F.xxhash64("text")
    )
    return (
        learned.join(sizes, "lang")
        .where(share < 1.5 * rows + 64)
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= rows)
        .select("text", "lang")
    )


class Tree:
    """The contexts of one language and what coding in them costs."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """counts: by order, sorted (context, symbol) codes and how often each was seen."""
        self.keys, self.log_n, self.direct = [], [], []
        self.contexts, self.escape, self.passed, self.rest = [], [], [], []
        before = None
        self.even = np.log(256.0)
        for order, (keys, n) in enumerate(counts):
            context = keys >> np.uint64(BITS)
            known, first = np.unique(context, return_index=True)
            sums = np.add.reduceat(n, first) if len(n) else np.zeros(0)
            kinds = np.diff(np.append(first, len(keys)))
            log_n = np.log(n)
            self.keys.append(keys)
            self.log_n.append(log_n)
            self.contexts.append(known)
            self.direct.append(np.repeat(np.log(sums + kinds), kinds) - log_n)
            self.escape.append(np.log(sums + kinds) - np.log(np.maximum(kinds, 1)))
            if order == 0:
                passed = rest = np.zeros(len(known))
                if len(kinds):
                    self.even = np.log(max(256 - int(kinds[0]), 1))
            else:  # the shorter context without the bytes of this one
                k_keys, k_n, k_known, k_sums, k_kinds = before
                shorter = np.searchsorted(k_known, known & _mask(order - 1))
                also = k_n[np.searchsorted(k_keys, keys & _mask(order))]
                left = k_sums[shorter] - (np.add.reduceat(also, first) if len(n) else 0)
                new = k_kinds[shorter] - kinds
                rest = np.log(np.maximum(left + new, 1))
                passed = np.where(new > 0, rest - np.log(np.maximum(new, 1)), 0.0)
            self.passed.append(passed)
            self.rest.append(rest)
            before = keys, n, known, sums, kinds

    def lengths(self, code: np.ndarray) -> np.ndarray:
        """Code length in nats of the last symbol of each code after the four before it."""
        out = np.zeros(len(code))
        open_ = np.arange(len(code))
        came = np.full(len(code), -1)  # context the escape came from, one order up
        for order in range(ORDER, -1, -1):
            keys, known = self.keys[order], self.contexts[order]
            if not len(keys):
                continue
            key = code[open_] & _mask(order + 1)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            escaped = came >= 0
            found, after = hit & ~escaped, hit & escaped
            out[open_[found]] += self.direct[order][at[found]]
            if after.any():
                out[open_[after]] += (
                    self.rest[order + 1][came[after]] - self.log_n[order][at[after]]
                )
            context = key >> np.uint64(BITS)
            place = np.minimum(np.searchsorted(known, context), len(known) - 1)
            there = known[place] == context
            fresh, further = ~hit & there & ~escaped, ~hit & escaped
            out[open_[fresh]] += self.escape[order][place[fresh]]
            if further.any():
                out[open_[further]] += self.passed[order + 1][came[further]]
            came = np.where(there, place, -1)[~hit]
            open_ = open_[~hit]
        out[open_] += self.even
        return out


def fit(labelled: DataFrame, most_nodes: int = MOST_NODES) -> dict[str, Tree]:
    """A tree for each language of labelled(text, lang), of ``most_nodes`` counts in all."""
    fives = (
        labelled.select("text", "lang")
        .mapInArrow(_counted, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("gram_order")
    masks = F.array(*[F.lit(int(_mask(k + 1))) for k in range(ORDER + 1)])
    nodes = stage(
        fives.select("lang", "code", "n", orders)
        .select(
            "lang",
            "gram_order",
            F.col("code").bitwiseAND(F.get(masks, F.col("gram_order"))).alias("code"),
            "n",
        )
        .groupBy("lang", "gram_order", "code")
        .agg(F.sum("n").alias("n"))
    )
    by_count = nodes.groupBy(F.least("n", F.lit(TOP_COUNT)).alias("n")).count()
    room, least = most_nodes, TOP_COUNT
    for row in sorted(by_count.collect(), key=lambda r: -r["n"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["n"]
    kept = nodes.where(F.col("n") >= least).groupBy("lang")
    return {
        r["lang"]: pickle.loads(r["tree"])  # written by the tasks of this very job
        for r in kept.applyInArrow(_planted, "lang string, tree binary").collect()
    }


def _planted(nodes: pa.Table) -> pa.Table:
    """The tree of one language, of at most ``most_nodes`` counts."""
    order = nodes["gram_order"].to_numpy()
    code, n = nodes["code"].to_numpy().view(np.uint64), nodes["n"].to_numpy().astype(float)
    counts = []
    for k in range(ORDER + 1):
        mine = np.flatnonzero(order == k)
        mine = mine[np.argsort(code[mine])]
        counts.append((code[mine], n[mine]))
    tree = pa.array([pickle.dumps(Tree(counts))], pa.binary())
    return pa.table({"lang": nodes["lang"].slice(0, 1).combine_chunks(), "tree": tree})


def lengths_of(column: pa.Array, trees: list[Tree]) -> np.ndarray:
    """Code length of each row's text in each tree."""
    out = np.zeros((len(column), len(trees)))
    for code, begin, bounds in codes(column):
        found, which = np.unique(code, return_inverse=True)
        first = int(np.searchsorted(bounds, begin, side="right")) - 1
        last = int(np.searchsorted(bounds, begin + len(code), side="left"))
        rows = np.arange(first, last)
        rows = rows[bounds[rows] < bounds[rows + 1]]
        cuts = np.maximum(bounds[rows] - begin, 0)
        for k, tree in enumerate(trees):
            out[rows, k] += np.add.reduceat(tree.lengths(found)[which], cuts)
    return out


def predict(
    docs: DataFrame,
    trees: dict[str, Tree],
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 5,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    names = sorted(trees, key=lambda name: name.encode())
    shared = docs.sparkSession.sparkContext.broadcast([trees[name] for name in names])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                total = lengths_of(piece.column(0), shared.value)
                best = total.argmin(axis=1)
                excess = total - total[np.arange(len(total)), best][:, None]
                posterior = 1.0 / np.exp(-excess).sum(axis=1)
                letters = piece.column(3).to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(1),
                        piece.column(2),
                        pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, letters)]),
                        pa.array(np.where(letters, posterior, 0.0)),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    letters = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.col(text).cast("string").alias("text"),
        F.col(doc_id).alias("doc_id"),
        held_out(F.col(doc_id), folds).alias("held_out"),
        letters.alias("letters"),
    )
    if not names:
        return rows.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    return rows.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 5,
    rows: int = SAMPLE_ROWS,
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold, predict all."""
    trees = fit(sample(docs, doc_id, text, lang, folds, rows), most_nodes)
    return predict(docs, trees, doc_id, text, folds)
