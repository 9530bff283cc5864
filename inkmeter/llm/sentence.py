"""SentencePiece encoding and decoding, by batched numpy lattices.

A text becomes units: white space marks and the signs up to the next mark.
Distinct units of a batch are sorted by length and advance together, one
position at a time; a unit takes part up to its own length.  For each position every substring
that ends there is hashed from running sums and, where a bitmap of leading bits
says it may be a piece, looked up among the sorted hashes of all pieces; the
best candidate's length is stored as a backpointer, and the pieces are read off
from the end.  Long units are first cut wherever no piece holds the two signs
beside each other, so that no merge can cross the cut.

For a unigram file the candidate of the highest total score is best.  For a BPE
file plain maxima would not give the file's own ids, so a candidate only counts
if BPE would leave it and the piece before it side by side.  That is decided
from the two pieces alone: their merges are undone, latest first, and no merge
across the border may come earlier than those undone.  Exactly one candidate of
each position passes, so ids equal those of the reference implementation.  Pairs
looked at are remembered in a table of fixed size.

Decoding gathers the bytes of all pieces of a batch at once.

Files that rewrite the text before they encode it (a normaliser, folded spaces)
or whose merge order is ambiguous (pieces defined by a user) are refused.

Cases: null text is empty and has no ids.  Signs without a piece become the
pieces of their bytes.  Unit caches are cleared at a fixed size, so memory
follows neither the vocabulary of the corpus nor the longest text.  Null ids
and repeated rows are rows like others.  An empty table gives an empty result.
Result columns replace columns of the same name.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmeter.llm.wordhash import pieces as parts_of

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BASE = np.uint64(0x9E3779B97F4A7C15)
CACHE = 1 << 18
SPREAD = np.uint64(0xD1B54A32D192ED03)
NO_LIMIT = np.int64(1 << 40)
LONG = 64  # signs of a unit that is cut
BLOCK = 1 << 17  # places of units that advance together
MAYBE_BITS = 20
PAIR_BITS = 20
#: What a normaliser would change: ligature, fraction, full width, case, spaces, composition
PROBE = "  \ufb01 \u00bd \uff21 Bb  e\u0301 "
PIECE_BYTES = 1 << 19


def _leading(hashes: np.ndarray) -> np.ndarray:
    """The leading bits by which pieces are sorted and found."""
    with np.errstate(over="ignore"):
        return (hashes * SPREAD) >> np.uint64(64 - MAYBE_BITS)


def _hash(points: np.ndarray) -> np.uint64:
    total = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in points:
            total = total * BASE + np.uint64(p) + np.uint64(1)
    return total


@dataclass
class Vocabulary:
    """Pieces in numpy form, by their number in order of hash."""

    unigram: bool
    prefix: bool
    hashes: np.ndarray  # sorted by leading bits
    ids: np.ndarray
    scores: np.ndarray
    ranks: np.ndarray  # order of merging, from the scores
    lengths: np.ndarray
    left: np.ndarray  # the two pieces a piece was last merged from; itself for a single sign
    right: np.ndarray
    usable: np.ndarray  # BPE reaches the piece
    longest: int
    byte_ids: np.ndarray
    powers: np.ndarray  # of the base, up to the longest piece
    maybe: np.ndarray  # by leading bits of a hash: some piece has them,
    first: np.ndarray  # the first hash that has them or more,
    more: np.ndarray  # by number: the next hash shares them
    inner: np.ndarray  # sorted pairs of signs that stand side by side in some piece
    data: np.ndarray  # bytes of all pieces by id, end to end
    begins: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the piece of each hash, or -1."""
        at = self.first[_leading(hashes)]
        found = self.hashes[at] == hashes
        out = np.where(found, at, np.int64(-1))
        left = np.flatnonzero(~found & self.more[at])
        at = at[left]
        while len(left):
            at = at + 1
            found = self.hashes[at] == hashes[left]
            out[left[found]] = at[found]
            on = ~found & self.more[at]
            left, at = left[on], at[on]
        return out


def _merge_tree(texts: list[str], rank: dict[str, int]) -> dict[str, tuple[str, str]]:
    """The last merge of each piece that BPE builds from its signs."""
    out = {}
    for text in texts:
        parts, last = list(text), None
        while len(parts) > 1:
            pairs = [rank.get(a + b, NO_LIMIT) for a, b in zip(parts[:-1], parts[1:], strict=True)]
            best = min(range(len(pairs)), key=pairs.__getitem__)
            if pairs[best] == NO_LIMIT:
                break
            last = (parts[best], parts[best + 1])
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 1 and last:
            out[text] = last
    return out


def load(path: str) -> Vocabulary:
    """Read a model file (on the driver; it may be any path the library opens)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(size)]
    byte_of = np.full(size, -1, dtype=np.int64)
    byte_ids = np.zeros(256, dtype=np.int64)
    for i in range(size):
        if model.is_byte(i):
            byte_of[i] = int(texts[i][3:5], 16)
            byte_ids[byte_of[i]] = i
    normal = [
        i
        for i in range(size)
        if byte_of[i] < 0 and not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    if any(MARK in texts[i].lstrip(MARK) for i in normal):
        raise ValueError("a piece spans words; units cannot be encoded apart")
    if not all(byte_ids >= 0) or not (byte_of >= 0).any():
        raise ValueError("a file with byte pieces is needed")
    scores = np.array([model.get_score(i) for i in normal])
    # Scores of BPE files are their merge order, negated
    unigram = not np.array_equal(scores, np.round(scores))
    points = [np.array([ord(c) for c in texts[i]]) for i in normal]
    hashes = np.array([_hash(p) for p in points], dtype=np.uint64)
    order = np.argsort(_leading(hashes), kind="stable")
    number = {texts[normal[o]]: k for k, o in enumerate(order.tolist())}
    rank = {texts[i]: int(round(-s)) for i, s in zip(normal, scores.tolist(), strict=True)}
    tree = {} if unigram else _merge_tree([texts[i] for i in normal if len(texts[i]) > 1], rank)
    left, right = np.arange(len(order)), np.arange(len(order))
    usable = np.ones(len(order), dtype=bool)
    for k, o in enumerate(order.tolist()):
        text = texts[normal[o]]
        if text in tree:
            left[k], right[k] = number[tree[text][0]], number[tree[text][1]]
        elif len(text) > 1 and not unigram:
            usable[k] = False
    lengths = np.array([len(p) for p in points])[order]
    plain = model.encode("a", out_type=str)
    if model.decode(model.encode(PROBE)) != PROBE:
        raise ValueError("the file changes texts before it encodes them")
    merged = [rank[t] for t in tree if t.strip(MARK)]  # runs of marks may share one
    if len(set(merged)) < len(merged):
        raise ValueError("two merges of the file have the same rank")
    maybe = np.zeros(1 << MAYBE_BITS, dtype=bool)
    maybe[_leading(hashes)] = True
    leading = _leading(hashes[order]).astype(np.int64)
    first = np.searchsorted(leading, np.arange(1 << MAYBE_BITS)).clip(max=len(order) - 1)
    inner = np.unique(np.concatenate([_pairs(p) for p in points]))
    shown = [
        bytes([b]) if b >= 0 else t.replace(MARK, " ").encode()
        for t, b in zip(texts, byte_of.tolist(), strict=True)
    ]
    begins = np.concatenate([[0], np.cumsum([len(b) for b in shown])])
    return Vocabulary(
        unigram, plain[0].startswith(MARK), hashes[order], np.array(normal)[order], scores[order],
        np.round(-scores[order]).astype(np.int64), lengths, left, right, usable,
        int(lengths.max()), byte_ids, _powers(int(lengths.max())), maybe,
        first.astype(np.int32), np.append(leading[1:] == leading[:-1], False), inner,
        np.frombuffer(b"".join(shown), dtype=np.uint8), begins,
    )


def _pairs(points: np.ndarray) -> np.ndarray:
    """Each sign and the next as one number."""
    points = points.astype(np.int64)
    return (points[:-1] << 21) | points[1:]


def stays_apart(v: Vocabulary, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether BPE leaves each pair of pieces side by side."""
    good = np.ones(len(first), dtype=bool)
    open_, a, b = np.arange(len(first)), first.copy(), second.copy()
    limit = np.full(len(first), NO_LIMIT)
    powers = v.powers
    while len(open_):
        with np.errstate(over="ignore"):
            joint = v.find(v.hashes[a] * powers[v.lengths[b]] + v.hashes[b])
        crosses = (joint >= 0) & (v.ranks[joint] < limit)
        good[open_[crosses]] = False
        open_, a, b, limit = open_[~crosses], a[~crosses], b[~crosses], limit[~crosses]
        whole_a, whole_b = v.right[a] == a, v.left[b] == b
        ended = whole_a & whole_b
        open_, a, b, whole_a, whole_b = (x[~ended] for x in (open_, a, b, whole_a, whole_b))
        # Undo the later of the last merges; a tie falls to the left one
        undo_a = ~whole_a & (whole_b | (v.ranks[a] > v.ranks[b]))
        limit = np.where(undo_a, v.ranks[a], v.ranks[b] + 1)
        a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
    return good


class Borders:
    """``stays_apart`` with the answers remembered, one pair a slot."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.slots = np.full(1 << PAIR_BITS, -1, dtype=np.int64)  # 2 * pair + answer

    def apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        pair = first * len(self.v.hashes) + second
        with np.errstate(over="ignore"):
            slot = (pair.astype(np.uint64) * BASE) >> np.uint64(64 - PAIR_BITS)
        held = self.slots[slot]
        good = (held & 1).astype(bool)
        new = np.flatnonzero((held >> 1) != pair)
        if len(new):
            fresh, back = np.unique(pair[new], return_inverse=True)
            answer = stays_apart(self.v, fresh // len(self.v.hashes), fresh % len(self.v.hashes))
            good[new] = answer[back]
            self.slots[slot[new]] = 2 * pair[new] + good[new]
        return good


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, n + 1):
            out[i] = out[i - 1] * BASE
    return out


def encode_sorted(
    v: Vocabulary, points: np.ndarray, lengths: np.ndarray, borders: Borders
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units, longest first, end to end, and how many each unit has.

    ``points`` holds a unit a row; what stands behind a unit's end is not read.
    """
    whole, length = points.shape
    # The units that reach a position are the first ones
    reach = np.searchsorted(-lengths, -np.arange(length + 1), side="right").tolist()
    sums = np.zeros((length + 1, whole), dtype=np.uint64)
    last = np.full((length + 1, whole), -1, dtype=np.int32)
    back = np.ones((length + 1, whole), dtype=np.int32)
    total = np.zeros((length + 1 if v.unigram else 1, whole))
    least = v.scores.min() - 10
    signs = points.T.astype(np.uint64) + np.uint64(1)
    for j in range(1, length + 1):
        most, n = min(j, v.longest), reach[j]
        with np.errstate(over="ignore"):
            sums[j, :n] = sums[j - 1, :n] * BASE + signs[j - 1, :n]
            # Row s holds the substrings of s + 1 signs that end here
            begun = sums[j - most : j, :n][::-1] * v.powers[1 : most + 1, None]
            hashes = (sums[j, :n] - begun).ravel()
        at = np.flatnonzero(v.maybe[_leading(hashes)])
        number = v.find(hashes[at])
        fits = (number >= 0) & v.usable[number]
        at, number = at[fits], number[fits]
        size, row = at // n + 1, at % n
        if v.unigram:
            # A sign without a piece is always a way on
            total[j, :n] = total[j - 1, :n] + least
            score = v.scores[number] + total[j - size, row]
            fits = score > total[j][row]
        else:
            before = last[j - size, row].astype(np.int64)
            fits = before < 0
            check = np.flatnonzero(~fits)
            fits[check] = borders.apart(before[check], number[check])
            score = v.scores[number]
        size, row, number, score = size[fits], row[fits], number[fits], score[fits]
        order = np.lexsort((-size, score))  # of several the best, of equal ones the shortest, is written last
        size, row, number = size[order], row[order], number[order]
        back[j, row], last[j, row] = size, number
        if v.unigram:
            total[j, row] = score[order]
    # Read off from the end, all units a piece at a time
    rows, places, values = [], [], []
    row, at = np.arange(whole), lengths
    while len(row):
        number = last[at, row]
        rows.append(row)
        places.append(at)
        values.append(
            np.where(number >= 0, v.ids[number], -1 - points[row, at - 1].astype(np.int64))
        )
        at = at - back[at, row]
        row, at = row[at > 0], at[at > 0]
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((np.concatenate(places), row))
    row, value = row[order], value[order]
    bare = np.flatnonzero(value < 0)
    if len(bare):
        signs = [v.byte_ids[list(chr(-1 - x).encode())] for x in value[bare].tolist()]
        times = np.ones(len(value), dtype=np.int64)
        times[bare] = [len(x) for x in signs]
        row, value = np.repeat(row, times), np.repeat(value, times)
        value[value < 0] = np.concatenate(signs)
    return value.astype(np.int32), np.bincount(row, minlength=whole)


class Encoder:
    """Encodes texts of a task; distinct units are encoded once."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.borders = Borders(v)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.counts = np.zeros(0, dtype=np.int64)

    def _learn(self, units: set[str]) -> None:
        if not units:
            return
        ordered = sorted(units, key=len, reverse=True)
        sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        ids, counts = [self.ids], [self.counts]
        at = 0
        while at < len(ordered):
            length = int(sizes[at])
            block = ordered[at : at + max(1, BLOCK // length)]
            lengths = sizes[at : at + len(block)]
            data = "".join(block).encode("utf-32-le", "surrogatepass")
            points = np.zeros((len(block), length), dtype=np.uint32)
            points[np.arange(length) < lengths[:, None]] = np.frombuffer(data, dtype=np.uint32)
            found, number = encode_sorted(self.v, points, lengths, self.borders)
            ids.append(found)
            counts.append(number)
            self.known.update(zip(block, range(len(self.known), len(self.known) + len(block)), strict=True))
            at += len(block)
        self.ids, self.counts = np.concatenate(ids), np.concatenate(counts)

    def _cut(self, units: list[str]) -> list[str]:
        """The units, long ones cut where no piece crosses."""
        if max(map(len, units), default=0) <= LONG:
            return units
        out: list[str] = []
        for unit in units:
            if len(unit) <= LONG:
                out.append(unit)
                continue
            points = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            cuts = np.flatnonzero(~np.isin(_pairs(points), self.v.inner)) + 1
            bounds = [0, *cuts.tolist(), len(unit)]
            out.extend(unit[b:e] for b, e in zip(bounds[:-1], bounds[1:], strict=True))
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and how many each text has."""
        lead = MARK if self.v.prefix else ""
        units = [self._cut(UNIT.findall(lead + t.replace(" ", MARK))) if t else [] for t in texts]
        if len(self.known) > CACHE:
            self.clear()
        self._learn(set().union(*units) - self.known.keys())
        sizes = np.array([len(us) for us in units], dtype=np.int64)
        number = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(units)), np.int64, int(sizes.sum())
        )
        counts, ends = self.counts[number], np.cumsum(self.counts)[number]
        before = np.cumsum(counts) - counts
        flat = np.arange(int(counts.sum())) + np.repeat(ends - counts - before, counts)
        per_text = np.bincount(
            np.repeat(np.arange(len(texts)), sizes), weights=counts, minlength=len(texts)
        )
        return self.ids[flat], per_text.astype(np.int64)


def _mark_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


codecs.register_error("mark_each_byte", _mark_each_byte)


def decode(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The texts of ids end to end; each byte that is no UTF-8 becomes a replacement mark."""
    sizes = v.begins[ids + 1] - v.begins[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = v.data[np.arange(ends[-1]) + np.repeat(v.begins[ids] - ends[:-1], sizes)].tobytes()
    places = ends[bounds].tolist()
    out = []
    for begin, end in zip(places[:-1], places[1:], strict=True):
        text = data[begin:end].decode("utf-8", "mark_each_byte").replace(MARK, " ")
        out.append(text[1:] if v.prefix and text.startswith(" ") else text)
    return out


def encode_batches(
    batches: Iterator[pa.RecordBatch], v: Vocabulary, at: int, check: bool
) -> Iterator[pa.RecordBatch]:
    """Rows, with the text in column ``at`` -> rows, n_ids, ids (and round_trip)."""
    encoder = Encoder(v)
    for whole in batches:
        begin = 0
        for part in parts_of(pa.record_batch([whole.column(at)], ["text"]), PIECE_BYTES):
            batch = whole.slice(begin, part.num_rows)
            begin += part.num_rows
            texts = part.column(0).to_pylist()
            flat, sizes = encoder.encode(texts)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns = [
                *batch.columns,
                pa.array(sizes),
                pa.ListArray.from_arrays(
                    pa.array(bounds), pa.array(flat)
                ),
            ]
            names = [*whole.schema.names, "n_ids", "ids"]
            if check:
                same = [
                    back == (t or "").replace(MARK, " ")
                    for back, t in zip(decode(v, flat, bounds), texts, strict=True)
                ]
                columns.append(pa.array(same, pa.bool_()))
                names.append("round_trip")
            yield pa.record_batch(columns, names)


def with_ids(df: DataFrame, path: str, text: str = "text", check: bool = False) -> DataFrame:
    """The rows with n_ids and ids, and on request whether decoding gives the text back."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load(path))
    extra = [T.StructField("n_ids", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if check:
        extra.append(T.StructField("round_trip", T.BooleanType()))
    new = {f.name for f in extra}
    kept = [c for c in df.columns if c not in new or c == text]
    plain = [f"c{i}" for i in range(len(kept))]
    at = kept.index(text)
    rows = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain, strict=True)])
    fields = [T.StructField(p, df.schema[c].dataType) for c, p in zip(kept, plain, strict=True)]
    coded = rows.mapInArrow(
        lambda b: encode_batches(b, vocabulary.value, at, check), T.StructType(fields + extra)
    )
    return coded.toDF(*kept, *[f.name for f in extra])


def decode_batches(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        texts = pa.array(decode(v, flat, bounds), pa.string(), mask=lists.is_null().to_numpy(False))
        yield pa.record_batch([batch.column(0), texts], ["key", "text"])


def decoded(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of rows of ids."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load(path))
    kind = df.schema[key].dataType.simpleString()
    return (
        df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
        .mapInArrow(lambda b: decode_batches(b, vocabulary.value), f"key {kind}, text string")
        .withColumnRenamed("key", key)
    )
