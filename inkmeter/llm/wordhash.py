"""Whole Arrow batches of texts to 64-bit word hashes, with numpy.

A batch's bytes are walked in slices of about a megabyte, cut where a document
ends or at white space, so memory does not follow the longest text.  A word's
hash is taken over blocks of eight bytes, each mixed and weighted with random
numbers of its place in the word; equal words have equal hashes wherever they
stand.  A polynomial of the bytes modulo 2**64 would not do: there are pairs of
words that collide for every base.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SEED = np.uint64(0xD1B54A32D192ED03)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
# White space 0, letters and digits (and all bytes beyond ASCII) 1, other signs 2
KIND = np.full(256, 2, dtype=np.uint8)
KIND[SPACE] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weights(begin: int, end: int) -> np.ndarray:
    """Random odd numbers of the places begin to end, the same in every process."""
    with np.errstate(over="ignore"):
        places = np.arange(begin + 1, end + 1, dtype=np.uint64) * BASE
    return mix(places + SEED) | np.uint64(1)


BLOCK = 8
FEW = 64  # blocks of words that are hashed side by side
_WEIGHTS = weights(0, 2 * FEW)
#: Bytes of a block that belong to a word with 0 to 8 bytes left
_LEFT = np.array([(1 << (8 * k)) - 1 for k in range(BLOCK + 1)], dtype=np.uint64)


def _word_hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    padded = np.append(part, np.zeros(BLOCK, dtype=np.uint8))
    blocks = np.ndarray(len(part) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    left = ends - starts
    out = left.astype(np.uint64)
    active = np.flatnonzero(left <= FEW * BLOCK)
    at, left = starts[active], left[active]
    with np.errstate(over="ignore"):
        for k in range(FEW):
            if not len(active):
                break
            block = blocks[at] & _LEFT[np.minimum(left, BLOCK)]
            out[active] += mix(block + _WEIGHTS[2 * k]) * _WEIGHTS[2 * k + 1]
            more = left > BLOCK
            active, at, left = active[more], at[more] + BLOCK, left[more] - BLOCK
        for word in np.flatnonzero(ends - starts > FEW * BLOCK):
            places = np.arange(starts[word], ends[word], BLOCK)
            block = blocks[places] & _LEFT[np.minimum(ends[word] - places, BLOCK)]
            weight = weights(0, 2 * len(places))
            out[word] += (mix(block + weight[::2]) * weight[1::2]).sum(dtype=np.uint64)
    return mix(out)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and where each row begins; null is empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(
        pa.large_string()
    )
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[0] == at[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of the rows of a batch, end to end."""

    hashes: np.ndarray  # uint64, one a word
    starts: np.ndarray  # where a word's bytes begin in the batch
    ends: np.ndarray
    rows: np.ndarray  # rows[i]:rows[i + 1] are the words of row i


def _slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    begin, size = 0, len(data)
    while begin < size:
        end = min(begin + SLICE, size)
        if end < size:
            at = bounds[np.searchsorted(bounds, end, side="right") - 1]  # a row's beginning
            if at > begin:
                end = int(at)
            else:
                back = np.flatnonzero(SPACE[data[begin:end]])
                if len(back):
                    end = begin + int(back[-1]) + 1
                else:
                    ahead = np.flatnonzero(SPACE[data[end:]])
                    end = min([size, *(end + ahead[:1] + 1)])
                    nxt = bounds[np.searchsorted(bounds, begin, side="right") :][:1]
                    end = int(min([end, *nxt]))
        yield begin, int(end)
        begin = int(end)


def words_of(column: pa.Array, fold: bool = True, signs: bool = False) -> Words:
    """Words between white space (space, tab to carriage return) of each row.

    ``signs`` splits runs of other signs off words, as words of their own.
    """
    data, bounds = string_bytes(column)
    if fold:
        data = FOLD[data]
    hashes, starts, ends = [], [], []
    inner = np.unique(bounds)
    for begin, end in _slices(data, inner):
        part = data[begin:end]
        kind = KIND[part] if signs else ~SPACE[part]
        word = kind > 0
        cut = inner[np.searchsorted(inner, begin) : np.searchsorted(inner, end)] - begin
        changes = kind[1:] != kind[:-1]
        first, last = word.copy(), word.copy()
        first[1:] &= changes
        last[:-1] &= changes
        if len(cut):  # rows meet without white space between them
            first[cut] = word[cut]
            before = cut[cut > 0] - 1
            last[before] = word[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(_word_hashes(part, s, e))
        starts.append(s + begin)
        ends.append(e + begin)
    empty = np.zeros(0, dtype=np.int64)
    starts_all = np.concatenate(starts) if starts else empty
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64),
        starts_all,
        np.concatenate(ends) if ends else empty,
        np.searchsorted(starts_all, bounds),
    )


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n neighbouring words; rows must not be crossed by the caller."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
        for i, weight in enumerate(weights(0, n)):
            total += hashes[i : len(hashes) - n + 1 + i] * weight
    return mix(total)


def pieces(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text in column 0, at least a row each."""
    _, bounds = string_bytes(batch.column(0))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[begin] + limit, side="right")) - 1
        end = max(begin + 1, min(end, batch.num_rows))
        yield batch.slice(begin, end - begin)
        begin = end
