"""Word shingle sets and their MinHash signatures, per Arrow batch, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from inkmeter.llm.wordhash import mix, pieces, rolling, words_of

PIECE = 1 << 20


def universal(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of n universal hash functions on 64 bits."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    return a | np.uint64(1), b


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and where rows begin.

    A row of fewer words than ``width`` has one shingle, its whole word
    sequence; a row without words has none.
    """
    words = words_of(column)
    grams = rolling(words.hashes, width)
    counts = np.diff(words.rows)
    row_of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words.hashes))
    whole = at + width <= words.rows[1:][row_of] if len(at) else np.zeros(0, dtype=bool)
    hashes, rows = grams[at[whole]], row_of[whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = []
        for row in short:
            part = words.hashes[words.rows[row] : words.rows[row + 1]]
            extra.append(mix(rolling(part, len(part)) + np.uint64(len(part)))[0])
        hashes = np.concatenate([hashes, np.array(extra, dtype=np.uint64)])
        rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows)) if len(counts) > 1 else np.argsort(hashes)
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(len(counts) + 1))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]


def minima(hashes: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The upper 32 bits of each universal hash's minimum over each row's set."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    out = np.zeros((len(bounds) - 1, len(a)), dtype=np.uint32)
    if len(full):
        begin = bounds[full]
        with np.errstate(over="ignore"):
            for i in range(len(a)):
                low = np.minimum.reduceat(hashes * a[i] + b[i], begin)
                out[full, i] = (low >> np.uint64(32)).astype(np.uint32)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` neighbouring minima."""
    n, k = signature.shape
    bands = signature.reshape(n, k // rows, rows).astype(np.uint64)
    rng = np.random.default_rng(rows)
    weights = rng.integers(0, 1 << 63, (k // rows, rows), dtype=np.uint64) | np.uint64(1)
    salt = rng.integers(0, 1 << 63, k // rows, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mix((bands * weights).sum(axis=2, dtype=np.uint64) + salt)


def feature_batches(
    batches: Iterator[pa.RecordBatch], width: int, hashes: int, band_rows: int, seed: int
) -> Iterator[pa.RecordBatch]:
    """id, text_hash, text -> id, text_hash, n_shingles, node, signature (16 bits each), bands."""
    a, b = universal(hashes, seed)
    n_bands = hashes // band_rows
    for whole in batches:
        columns = [whole["text"], whole["id"], whole["text_hash"]]
        for batch in pieces(pa.record_batch(columns, ["text", "id", "text_hash"]), PIECE):
            sets, bounds = shingle_sets(batch.column(0), width)
            signature = minima(sets, bounds, a, b)
            node = mix(row_sums(mix(sets + np.uint64(1)), bounds)).view(np.int64)
            short = np.ascontiguousarray((signature & 0xFFFF).astype(np.uint16))
            keys = np.ascontiguousarray(band_keys(signature, band_rows)).view(np.int64)
            rows = batch.num_rows
            yield pa.record_batch(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.diff(bounds)),
                    pa.array(node),
                    pa.array([r.tobytes() for r in short], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (rows + 1) * n_bands, n_bands, dtype=np.int32)),
                        pa.array(keys.ravel()),
                    ),
                ],
                ["id", "text_hash", "n_shingles", "node", "signature", "bands"],
            )
