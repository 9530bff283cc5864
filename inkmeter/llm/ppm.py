"""Language-model scores: prediction by partial matching over bytes, and a unigram base.

The model is a trie of byte contexts.  Documents are counted in one pass as
(context, next symbol) of the full order; shorter contexts follow by summing
what the training documents hold.  A text is its lower-cased words joined by one
space, and an end, so that the model and the base score the same event.  A
symbol is predicted from the longest context known; a context that has not seen
it escapes to the next shorter one.  The escape estimate is the number of
distinct symbols the context has seen (method C), and symbols seen in the longer
context are excluded from the shorter one's counts.

Every context counted is kept, so the model grows with the corpus; it is a table
for each order and is never gathered.  A position's share depends only on its
symbol and the full context, so shares are worked out once for each such key
that any document holds: from its own context's row where training has seen the
key, and by one join for each shorter order where not.  The keys that make up at
least 1 / ``most_keys`` of all symbols, hence at most that many, are looked up
in a broadcast table; the rest are joined with their shares by key.  As those
are rare, no key of that join is common.  One pass over the texts adds up what
the tables hold and keeps, in the document's row, what they do not.

The base adds log10((c + 1) / (N + V + 1)) over tokens.  Tokens that make up at
least 1 / ``most_head`` of the training text, so at most that many, are looked
up in a broadcast table; the rest are joined with their counts by token.  Words
are told apart by 64-bit hashes.

Cases: null text is empty and is one end token.  A null id counts as empty
text in the split.  Repeated rows are rows of their own, with equal scores.
Without training documents every symbol and token is unseen.  An empty table
gives an empty result.  Further columns are never looked at, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage
from inkmeter.llm.wordhash import FOLD, SPACE, Words, pieces, string_bytes, words_of

ORDER = 5
MOST_KEYS = 1 << 22
MOST_HEAD = 1 << 20
END, START = 256, 257
SYMBOLS = 257
BITS = 9
LOG10 = float(np.log(10.0))
FLUSH = 1 << 21
# Arrays of eight bytes a letter stay in a core's cache
PIECE = 1 << 19


def symbols_of(column: pa.Array, words: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's symbols behind ``order`` start marks, end to end, and the row of each."""
    data, _ = string_bytes(column)
    rows = len(column)
    row = np.repeat(np.arange(rows), np.diff(words.rows))
    more = np.zeros(len(row), dtype=np.int64)
    more[:-1] = row[1:] == row[:-1]
    edge = np.zeros(len(data) + 2, dtype=np.int8)
    edge[words.starts] += 1
    edge[words.ends + more] -= 1
    text = np.where(SPACE[data], np.uint8(32), FOLD[data])
    text = text[np.cumsum(edge[: len(data)], dtype=np.int8) > 0]
    sizes = np.bincount(row, weights=words.ends - words.starts + more, minlength=rows)
    sizes = sizes.astype(np.int64)
    out = np.full(len(text) + rows * (order + 1), START, dtype=np.int16)
    text_row = np.repeat(np.arange(rows), sizes)
    out[np.arange(len(text)) + text_row * (order + 1) + order] = text
    ends = np.cumsum(sizes + order + 1) - 1
    out[ends] = END
    return out, np.repeat(np.arange(rows), sizes + order + 1)


def keys_of(symbols: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Where symbols other than start marks stand, and each with its context as one number."""
    at = np.flatnonzero(symbols != START)
    # Windows ending at each place from ``order`` on; no other symbol stands before
    key = symbols[: max(0, len(symbols) - order)].astype(np.int64)
    for begin in range(1, order + 1):
        key <<= BITS
        key |= symbols[begin : begin + len(key)]
    return at, key[at - order]


class Tally:
    """Counts of keys in bounded memory; full tallies are handed on."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        value, count = np.unique(keys, return_counts=True)
        self.keys.append(value)
        self.counts.append(count)
        self.size += len(value)
        if self.size > FLUSH:
            self._merge()

    def _merge(self) -> None:
        value, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate(self.counts), minlength=len(value))
        self.keys, self.counts, self.size = [value], [count.astype(np.int64)], len(value)

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size > least:
            self._merge()
            if self.size > least:
                yield pa.record_batch(
                    [pa.array(self.keys[0].view(np.int64)), pa.array(self.counts[0])],
                    ["key", "times"],
                )
                self.__init__()


def context_batches(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """text, held_out -> key, times: contexts of the full order with their next symbol.

    The lowest bit of a key tells whether the document was held out.
    """
    tally = Tally()
    for whole in batches:
        for batch in pieces(whole, PIECE):
            words = words_of(batch.column(0))
            symbols, row = symbols_of(batch.column(0), words, order)
            at, keys = keys_of(symbols, order)
            held_out = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            tally.add((keys << 1) | held_out[row[at]])
            yield from tally.take(FLUSH // 2)
    yield from tally.take()


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> key, times: words of the task's documents."""
    tally = Tally()
    for whole in batches:
        for batch in pieces(whole, PIECE):
            tally.add(words_of(batch.column(0)).hashes)
            yield from tally.take(FLUSH // 2)
    yield from tally.take()


class Lookup:
    """Numbers of known keys, by open addressing, for many keys at once."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int64)
        self.numbers = np.full(1 << bits, -1, dtype=np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.numbers[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            chosen = left[free][first]
            self.slots[slot], self.numbers[slot] = keys[chosen], chosen
            done = self.numbers[at] == left
            left, at = left[~done], (at[~done] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where unknown."""
        at = self._home(keys)
        number = self.numbers[at]
        wrong = np.flatnonzero((number >= 0) & (self.slots[at] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            number[wrong] = self.numbers[at[wrong]]
            other = (number[wrong] >= 0) & (self.slots[at[wrong]] != keys[wrong])
            wrong = wrong[other]
        return number


def counted(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of key and row, and how often each occurs, by row."""
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    return key[begin], row[begin], np.diff(np.append(begin, len(key)))


def rest_of(words: tuple, contexts: tuple, rows: int) -> pa.ListArray:
    """Each row's keys in neither table, from ``counted`` words and contexts."""
    key, row, times = (np.concatenate(both) for both in zip(words, contexts, strict=True))
    is_word = np.arange(len(key)) < len(words[0])
    order = np.argsort(row, kind="stable")
    entries = pa.StructArray.from_arrays(
        [
            pa.array(is_word[order]),
            pa.array(key[order]),
            pa.array(times[order].astype(np.int32)),
        ],
        ["is_word", "key", "times"],
    )
    bounds = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(row, minlength=rows), out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), entries)


def score_batches(
    batches: Iterator[pa.RecordBatch],
    order: int,
    often: Lookup,
    often_shares: np.ndarray,
    head: Lookup,
    head_logs: np.ndarray,
    end_log: float,
) -> Iterator[pa.RecordBatch]:
    """text, id, row_key, held_out -> the last three, sums over known keys, the rest's keys."""
    for whole in batches:
        for batch in pieces(whole, PIECE):
            rows = batch.num_rows
            words = words_of(batch.column(0))
            symbols, row = symbols_of(batch.column(0), words, order)
            at, keys = keys_of(symbols, order)
            row = row[at]
            number = often.find(keys)
            known = number >= 0
            score = np.bincount(
                row[known], weights=often_shares[number[known]], minlength=rows
            )
            contexts = counted(keys[~known], row[~known])
            tokens = words.hashes.view(np.int64)
            row = np.repeat(np.arange(rows), np.diff(words.rows))
            number = head.find(tokens)
            known = number >= 0
            base = np.bincount(row[known], weights=head_logs[number[known]], minlength=rows)
            n_known = np.bincount(row[known], minlength=rows)
            yield pa.record_batch(
                [
                    *(batch.column(i) for i in (1, 2, 3)),
                    pa.array(np.diff(words.rows) + 1),
                    pa.array(n_known + int(end_log > 0)),
                    pa.array(base + end_log),
                    pa.array(score, pa.float64()),
                    rest_of(counted(tokens[~known], row[~known]), contexts, rows),
                ],
                [
                    "id", "row_key", "held_out", "n_tokens", "n_known", "base_sum", "score", "rest",
                ],
            )


def _sum(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0).cast("long"), lambda n, e: n + e["times"])


def _symbols(entries: Column) -> Column:
    return F.transform(entries, lambda e: e["symbol"])


def _after(missed: DataFrame, nodes: DataFrame, d: int) -> DataFrame:
    """Keys without a share yet, after the contexts of ``d`` symbols were asked.

    ``log`` is the log of the share so far, ``gone`` the symbols of the longer
    contexts, ``done`` whether a context had the symbol.
    """
    context = F.shiftright("key", BITS).bitwiseAND(F.lit((1 << BITS * d) - 1))
    # Keys that are done meet no context, and are not gathered where many share one
    asked = missed.withColumn("at", F.when(F.col("done"), -1 - F.col("key")).otherwise(context))
    # At most 258 rows of at most 257 symbols of the lowest two levels
    asked = asked.join(
        F.broadcast(nodes) if d < 2 else nodes, F.col("at") == F.col("context"), "left"
    )
    left = asked.withColumn(
        "left", F.filter("kept", lambda e: ~F.array_contains(F.col("gone"), e["symbol"]))
    )
    symbol = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    sums = left.withColumn("held", _sum(F.col("left"))).withColumn(
        # Every kind speaks for one unseen symbol
        "escape",
        F.size("kept") - F.size("gone"),
    )
    found = sums.withColumn(
        "found", F.get(F.filter("left", lambda e: e["symbol"] == symbol), F.lit(0))["times"]
    )
    both = F.col("held") + F.col("escape")
    share = F.when(F.col("found").isNotNull(), F.col("found") / both).when(
        F.col("escape") > 0, F.col("escape") / both
    )
    return found.select(
        "key",
        "seen",
        (F.col("log") + F.coalesce(F.log(share), F.lit(0.0))).alias("log"),
        F.coalesce(_symbols(F.col("kept")), F.col("gone")).alias("gone"),
        (F.col("done") | F.col("found").isNotNull()).alias("done"),
    )


def shares(rows: DataFrame, order: int) -> DataFrame:
    """key, seen, share: each (context, symbol) of any text of ``rows`` (text, held_out).

    ``seen`` is how often all texts hold it, ``share`` the natural log of its
    probability in a model of the texts that are not held out.
    """
    counts = stage(
        rows.mapInArrow(lambda b: context_batches(b, order), "tagged long, times long")
        .groupBy(F.shiftright("tagged", 1).alias("key"))
        .agg(
            F.sum(F.when(F.col("tagged") % 2 == 0, F.col("times")).otherwise(0)).alias("times"),
            F.sum("times").alias("seen"),
        )
    )
    context = F.shiftright("key", BITS).alias("context")
    symbol = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("symbol")

    # A context has at most 257 symbols
    whole = (
        counts.groupBy(context)
        .agg(
            F.sum("times").alias("total"),
            F.count_if(F.col("times") > 0).alias("kinds"),
            F.collect_list(F.struct(symbol, "times", "seen")).alias("all"),
        )
        .withColumn("symbols", _symbols(F.filter("all", lambda e: e["times"] > 0)))
        .select("context", "total", "kinds", "symbols", F.explode("all").alias("e"))
    )
    done = F.array_contains("symbols", F.col("e.symbol"))
    both = F.col("total") + F.col("kinds")
    share = F.when(done, F.col("e.times") / both).when(
        F.size("symbols") > 0, F.col("kinds") / both
    )
    first = stage(
        whole.select(
            F.shiftleft("context", BITS).bitwiseOR(F.col("e.symbol").cast("long")).alias("key"),
            F.col("e.seen").alias("seen"),
            F.coalesce(F.log(share), F.lit(0.0)).alias("log"),
            F.when(~done, F.col("symbols")).alias("gone"),
            done.alias("done"),
        )
    )
    missed = first.where("NOT done")
    counts = counts.where("times > 0")
    for d in range(order - 1, -1, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << BITS * (d + 1)) - 1))
        counts = stage(counts.groupBy(shorter.alias("key")).agg(F.sum("times").alias("times")))
        nodes = counts.groupBy(context).agg(
            F.collect_list(F.struct(symbol, "times")).alias("kept")
        )
        missed = _after(missed, nodes, d)
    # Symbols the root has not seen share its escape evenly
    unseen = -F.log(F.greatest(F.lit(1), SYMBOLS - F.size("gone")).cast("double"))
    log = F.col("log") + F.when(F.col("done"), 0.0).otherwise(unseen)
    return stage(
        first.where("done")
        .select("key", "seen", F.col("log").alias("share"))
        .unionAll(missed.select("key", "seen", log.alias("share")))
    )


def score(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    most_head: int = MOST_HEAD,
    folds: int = 7,
    held: int = 2,
    most_keys: int = MOST_KEYS,
) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(text).alias("text"),
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.col(key), F.col(text)).alias("row_key"),
        (F.crc32(name) % folds == held).alias("held_out"),
    )
    learning = rows.where("NOT held_out").select("text")
    known = shares(rows.select("text", "held_out"), order)
    symbols = known.agg(F.sum("seen")).first()[0] or 0
    # At most most_keys rows
    often = known.where(F.col("seen") * most_keys >= symbols).select("key", "share").toArrow()
    trie = spark.sparkContext.broadcast(
        (Lookup(often["key"].to_numpy()), often["share"].to_numpy())
    )
    vocabulary = stage(
        learning.mapInArrow(token_batches, "key long, times long")
        .groupBy("key")
        .agg(F.sum("times").alias("times"))
    )
    kinds, words = vocabulary.agg(F.count("*"), F.sum("times")).first()
    texts = learning.count()
    total = (words or 0) + texts
    size = kinds + (1 if texts else 0)
    # At most most_head rows
    often = vocabulary.where(F.col("times") * most_head >= (words or 0)).toArrow()
    head = spark.sparkContext.broadcast(
        (Lookup(often["key"].to_numpy()), np.log10(often["times"].to_numpy() + 1.0))
    )
    end_log = float(np.log10(texts + 1.0))
    scored = stage(
        rows.mapInArrow(
            lambda b: score_batches(b, order, *trie.value, *head.value, end_log),
            "id long, row_key long, held_out boolean, n_tokens long, n_known long, "
            "base_sum double, score double, "
            "rest array<struct<is_word: boolean, key: long, times: int>>",
        )
    )
    tail = scored.select("row_key", F.inline("rest"))
    values = vocabulary.select(
        F.lit(True).alias("is_word"), "key", F.log10(F.col("times") + 1).alias("value")
    ).unionAll(
        known.where(F.col("seen") * most_keys < symbols).select(
            F.lit(False).alias("is_word"), "key", F.col("share").alias("value")
        )
    )
    product = F.col("times") * F.col("value")
    found = (
        tail.join(values, ["is_word", "key"])
        .groupBy("row_key")
        .agg(
            F.sum(F.when(F.col("is_word"), F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.when(F.col("is_word"), product).otherwise(0.0)).alias("tail_sum"),
            F.sum(F.when(F.col("is_word"), 0.0).otherwise(product)).alias("tail_score"),
        )
    )
    # Repeated rows each sent their words
    alike = scored.groupBy("row_key").agg(F.count("*").alias("rows"))
    of_row = found.join(alike, "row_key").select(
        "row_key",
        (F.col("tail_known") / F.col("rows")).cast("long").alias("tail_known"),
        (F.col("tail_sum") / F.col("rows")).alias("tail_sum"),
        (F.col("tail_score") / F.col("rows")).alias("tail_score"),
    )
    return scored.join(of_row, "row_key", "left").select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (
            F.col("base_sum")
            + F.coalesce("tail_sum", F.lit(0.0))
            - F.col("n_tokens") * float(np.log10(total + size + 1))
        ).alias("base_score"),
        ((F.col("score") + F.coalesce("tail_score", F.lit(0.0))) / LOG10).alias("score"),
    )
