"""Sorted Arrow batches cut where a key changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by keys, cut so that no run of equal keys is torn: rows, run bounds."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and last != tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        cuts = np.flatnonzero(new)
        if len(cuts):
            held.append(batch.slice(0, cuts[-1]))
            yield _bounded(held, keys)
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield _bounded(held, keys)


def _bounded(held: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    rows = pa.Table.from_batches(held).combine_chunks()
    new = np.ones(rows.num_rows, dtype=bool)
    if rows.num_rows:
        new[1:] = False
        for k in keys:
            c = rows[k].to_numpy()
            new[1:] |= c[1:] != c[:-1]
    return rows, np.append(np.flatnonzero(new), rows.num_rows)
