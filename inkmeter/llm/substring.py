"""Removing passages that stand anywhere else in the corpus, word by word.

A window is a fixed number of consecutive words of one document; every word of
a window that starts anywhere else too is removed.  Windows are compared by
64-bit hashes of their words.

1. Each window names an anchor: the smallest hash among the short word groups
   inside it.  Equal windows name equal anchors, so a window can only repeat if
   its anchor does.  Anchors are counted; neighbouring windows mostly share
   one, so these are few.
2. A Bloom filter of repeated anchors, of bounded size, is sent to all tasks,
   which emit the windows of possibly repeated anchors, packed by anchor.
3. Rows of one anchor meet in one task and equal windows are found there.
   Anchors that stand at more places than fit into a task's memory, told by a
   second Bloom filter, go another way: their windows are counted with map-side
   combining and joined, which adaptive execution splits.
4. The word ranges found return to their documents, which are looked up by a
   third filter, so that only documents that lose words are shuffled.

Cases: null text has no words.  A text shorter than a window loses nothing.
Repeated rows, null ids included, are copies of each other: long enough, both
go.  Overlapping repeats within one document count.  An empty table gives an
empty result.  Further columns are never looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.bloom import filter_bits, set_bits, with_possible
from inkmeter.llm.runs import whole_runs
from inkmeter.llm.staging import stage
from inkmeter.llm.wordhash import SPACE, mix, pieces, rolling, string_bytes, words_of

WINDOW = 35
GROUP = 8
# Most windows in one packed row
PACK = 64
ANCHOR_BITS = 1 << 26
# An anchor of more places goes the way for many; as packed windows these are some 25 MB
HOT_PLACES = 200_000


def sliding_min(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimum of each n neighbouring values and where it stands first."""
    place = np.arange(len(values))
    if len(values) < n:
        return values[:0], place[:0]

    def lower(shift: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = low[:count], low[shift : shift + count]
        less = right < left
        return np.where(less, right, left), np.where(less, at[shift : shift + count], at[:count])

    low, at, span = values, place, 1
    while span * 2 <= n:
        low, at = lower(span, len(low) - span)
        span *= 2
    return lower(n - span, len(values) - n + 1)


def windows_of(column: pa.Array, window: int, group: int) -> tuple[np.ndarray, ...]:
    """Of each window: its hash, its anchor, where that stands, its row, its first word there."""
    words = words_of(column, fold=False)
    row = np.repeat(np.arange(len(column)), np.diff(words.rows))
    whole = rolling(words.hashes, window)
    anchor, stands = sliding_min(rolling(words.hashes, group), window - group + 1)
    at = np.arange(len(whole))
    inside = at[at + window <= words.rows[1:][row[: len(whole)]]]
    rows = row[inside]
    return whole[inside], anchor[inside], stands[inside], rows, inside - words.rows[rows]


def anchor_batches(
    batches: Iterator[pa.RecordBatch], window: int, group: int
) -> Iterator[pa.RecordBatch]:
    """text -> anchor, times: at how many places an anchor stands."""
    for whole in batches:
        for batch in pieces(whole):
            _, anchor, stands, _, _ = windows_of(batch.column(0), window, group)
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = stands[1:] != stands[:-1]
            value, times = np.unique(anchor[new], return_counts=True)
            yield pa.record_batch(
                [pa.array(value.view(np.int64)), pa.array(times)],
                ["anchor", "times"],
            )


def anchor_bits(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bits of a filter of ``bits`` for each anchor."""
    mixed = mix(anchor + np.uint64(1))
    return [
        (mixed % np.uint64(bits)).astype(np.int64),
        ((mixed >> np.uint64(20)) * np.uint64(0x9E3779B97F4A7C15) % np.uint64(bits)).astype(np.int64),
    ]


def bit_batches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """anchor -> word, bits: set bits of the filter, 64 to a row."""
    for batch in batches:
        anchor = batch.column(0).to_numpy().view(np.uint64)
        at = np.concatenate(anchor_bits(anchor, bits))
        yield pa.record_batch(
            [pa.array(at >> 6), pa.array(np.left_shift(np.int64(1), at & 63))], ["word", "bits"]
        )


def in_filter(anchor: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether all bits of each anchor are set."""
    found = np.ones(len(anchor), dtype=bool)
    for at in anchor_bits(anchor, len(table) * 64):
        found &= (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return found


def window_batches(
    batches: Iterator[pa.RecordBatch],
    repeated: np.ndarray,
    frequent: np.ndarray,
    window: int,
    group: int,
) -> Iterator[pa.RecordBatch]:
    """text, id, text_hash -> anchor, frequent, id, text_hash, first, windows."""
    for whole in batches:
        for batch in pieces(whole):
            hashes, anchor, _, row, first = windows_of(batch.column(0), window, group)
            maybe = in_filter(anchor, repeated)
            hashes, anchor, row, first = (x[maybe] for x in (hashes, anchor, row, first))
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (
                (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (first[1:] != first[:-1] + 1)
            )
            begin = np.flatnonzero(new)
            since = np.arange(len(anchor)) - np.repeat(begin, np.diff(np.append(begin, len(anchor))))
            begin = np.flatnonzero(since % PACK == 0)
            where = pa.array(row[begin])
            yield pa.record_batch(
                [
                    pa.array(anchor[begin].view(np.int64)),
                    pa.array(in_filter(anchor[begin], frequent)),
                    batch.column(1).take(where),
                    batch.column(2).take(where),
                    pa.array(first[begin]),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(begin, len(anchor)).astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                    ),
                ],
                ["anchor", "frequent", "id", "text_hash", "first", "windows"],
            )


def repeat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed windows sorted by anchor -> id, text_hash, first, last: runs of repeated windows."""
    for rows, _ in whole_runs(batches, ["anchor"]):
        if not rows.num_rows:
            continue
        lists = rows["windows"].combine_chunks()
        hashes = lists.flatten().to_numpy()
        counts = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(rows.num_rows), counts)
        start = np.cumsum(counts) - counts
        place = rows["first"].to_numpy()[row] + np.arange(len(hashes)) - start[row]
        _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[back] > 1)
        row, place = row[again], place[again]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(row)) - 1
        where = pa.array(row[begin])
        yield pa.record_batch(
            [
                rows["id"].combine_chunks().take(where),
                rows["text_hash"].combine_chunks().take(where),
                pa.array(place[begin]),
                pa.array(place[end] if len(row) else place[:0]),
            ],
            ["id", "text_hash", "first", "last"],
        )


def removed_batches(
    batches: Iterator[pa.RecordBatch], window: int, texts: bool
) -> Iterator[pa.RecordBatch]:
    """text, id, firsts, lasts -> id, n_words, n_removed, kept_sha256 (and the kept text)."""
    for whole in batches:
        for batch in pieces(whole):
            words = words_of(batch.column(0), fold=False)
            data, _ = string_bytes(batch.column(0))
            cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            firsts, lasts = batch.column(2), batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), np.diff(firsts.offsets.to_numpy()))
            if len(row):
                base = words.rows[row]
                np.add.at(cover, base + firsts.flatten().to_numpy(), 1)
                np.add.at(cover, base + lasts.flatten().to_numpy() + window, -1)
            keep = np.cumsum(cover[:-1]) == 0
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.rows))[keep]
            start, end = words.starts[keep], words.ends[keep]
            # Each kept word takes the white space behind it along, the last of a row does not
            more = np.zeros(len(start), dtype=np.int64)
            more[:-1] = row[1:] == row[:-1]
            edge = np.zeros(len(data) + 2, dtype=np.int8)
            edge[start] += 1
            edge[end + more] -= 1
            spaced = np.where(SPACE[data], np.uint8(32), data)
            out = spaced[np.cumsum(edge[: len(data)], dtype=np.int8) > 0].tobytes()
            sizes = np.bincount(row, weights=end - start + more, minlength=batch.num_rows)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64).tolist()
            kept = [out[b:e] for b, e in zip(bounds[:-1], bounds[1:], strict=True)]
            n_words = np.diff(words.rows)
            columns = {
                "id": batch.column(1),
                "n_words": pa.array(n_words),
                "n_removed": pa.array(n_words - np.bincount(row, minlength=batch.num_rows)),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            }
            if texts:
                columns["kept_text"] = pa.array([k.decode("utf-8", "replace") for k in kept])
            yield pa.record_batch(list(columns.values()), list(columns))


def _filter_of(anchors: DataFrame) -> np.ndarray:
    """The filter of a table of anchors; at most ANCHOR_BITS / 64 rows, 8 MB, reach the driver."""
    bits = filter_bits(anchors.count(), ANCHOR_BITS)
    words = (
        anchors.select("anchor")
        .mapInArrow(lambda b: bit_batches(b, bits), "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table


def _ranges(rows: DataFrame, window: int, group: int, hot_places: int) -> DataFrame:
    """id, text_hash, first, last: runs of windows that stand elsewhere too."""
    often = stage(
        rows.select("text")
        .mapInArrow(lambda b: anchor_batches(b, window, group), "anchor long, times long")
        .groupBy("anchor")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
    )
    repeated = _filter_of(often)
    frequent = _filter_of(often.where(F.col("times") > hot_places))
    packed = stage(
        rows.mapInArrow(
            lambda b: window_batches(b, repeated, frequent, window, group),
            "anchor long, frequent boolean, id long, text_hash long, first long, "
            "windows array<long>",
        )
    )
    cold = (
        packed.where("NOT frequent")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(repeat_batches, "id long, text_hash long, first long, last long")
    )
    single = packed.where("frequent").select(
        "id", "text_hash", "first", F.posexplode("windows").alias("behind", "window")
    )
    twice = single.groupBy("window").count().where("count > 1").select("window")
    found = single.join(twice, "window").select(
        "id",
        "text_hash",
        (F.col("first") + F.col("behind")).alias("first"),
        (F.col("first") + F.col("behind")).alias("last"),
    )
    return cold.union(found)


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    group: int = GROUP,
    texts: bool = False,
    hot_places: int = HOT_PLACES,
) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_sha256, and kept_text on request."""
    if window <= group:
        raise ValueError("a window is longer than the word groups it is found by")
    rows = docs.select(
        F.col(text).alias("text"),
        F.col(key).cast("long").alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    # Ranges of a document, bounded by its length; copies of a row bring each range several times
    ranges = stage(
        _ranges(rows, window, group, hot_places)
        .distinct()
        .groupBy("id", "text_hash")
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    )
    names = ["id", "text_hash"]
    bits = filter_bits(ranges.count())
    words = stage(set_bits(ranges, names, bits))
    maybe = with_possible(rows, names, words, bits)
    none = F.array().cast("array<bigint>")
    same = F.col("r.id").eqNullSafe(F.col("g.id")) & (F.col("r.text_hash") == F.col("g.text_hash"))
    joined = (
        maybe.where("possible")
        .alias("r")
        .join(ranges.alias("g"), same, "left")
        .select(
            "text",
            "r.id",
            F.coalesce("firsts", none).alias("firsts"),
            F.coalesce("lasts", none).alias("lasts"),
        )
    )
    alone = maybe.where("NOT possible").select(
        "text", "id", none.alias("firsts"), none.alias("lasts")
    )
    schema = "id long, n_words long, n_removed long, kept_sha256 string"
    if texts:
        schema += ", kept_text string"
    return (
        alone.union(joined)
        .mapInArrow(lambda b: removed_batches(b, window, texts), schema)
        .withColumnRenamed("id", key)
    )
