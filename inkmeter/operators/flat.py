"""Parsed units of an Arrow batch as flat arrays.

A token in nested arrays costs an interpreted call for everything asked of it.
Here the tokens of a few units lie one behind the other: what depends on the
spelling alone is asked once for each distinct spelling, the rest is array
arithmetic.  Everything stays within the task that read the units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Tokens that are laid flat at once; a unit is never split
MOST_TOKENS = 1 << 19
# What Java's ``$`` may leave behind a match
_LINE_ENDS = ("\r\n", "\n", "\r", "\x85", "\u2028", "\u2029")
# Hops of a token that is not in its sentence; no number of doublings makes it positive
_NOWHERE = -(1 << 40)


def is_word(token: str) -> bool:
    """``tokens.is_alpha`` of a string: letters only."""
    if token.isalpha() or not token.endswith(_LINE_ENDS):
        return token.isalpha()
    return token[: -2 if token.endswith("\r\n") else -1].isalpha()


def fold(token: str) -> str:
    """``tokens.fold_case`` of a string."""
    return token.replace("\u0130", "i").lower()


def words(values: pa.Array) -> np.ndarray:
    """``is_word`` of each string without nulls; Python is asked about those beyond ASCII letters."""
    found = pc.ascii_is_alpha(values).to_numpy(zero_copy_only=False).copy()
    left = np.flatnonzero(~found)
    found[left] = [is_word(v) for v in python_strings(values.take(pa.array(left)))]
    return found


def lowered(values: pa.Array, of: Callable[[str], str]) -> pa.Array:
    """What ``of`` makes of each string without nulls; of ASCII it makes lower case."""
    beyond = pc.invert(pc.string_is_ascii(values))
    made = [of(v) for v in python_strings(values.filter(beyond))]
    return pc.replace_with_mask(pc.ascii_lower(values), beyond, pa.array(made, values.type))


def python_strings(values: pa.Array) -> list[str]:
    """As ``to_pylist``, which makes an Arrow scalar of every string."""
    return values.to_numpy(zero_copy_only=False).tolist()


def lengths(lists: pa.Array) -> np.ndarray:
    """Sizes of lists; null is empty."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("int64")


def bounds(sizes: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)])


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of each run of values."""
    return np.diff(bounds(values.astype("int64"))[ends])


def lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    """The values in runs."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, most: int = MOST_TOKENS
) -> Iterator[pa.RecordBatch]:
    """The rows in runs whose nested tokens begin within ``most`` tokens."""
    for batch in batches:
        nested = batch.column(column)
        per_unit = sums(lengths(nested.flatten()), bounds(lengths(nested)))
        place = bounds(per_unit)[:-1] // most
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


class Spellings:
    """Strings as numbers of their distinct values; null is the last number.

    A dictionary that comes with the strings is taken as it is, even if a value
    stands in it twice.
    """

    def __init__(self, strings: pa.Array) -> None:
        encoded = strings if pa.types.is_dictionary(strings.type) else pc.dictionary_encode(strings)
        self.dictionary: pa.Array = encoded.dictionary
        missing = len(self.dictionary)
        self.codes = pc.fill_null(encoded.indices, missing).to_numpy(zero_copy_only=False)

    def tokens(self, each: np.ndarray, null: object) -> np.ndarray:
        """For each string what its distinct value has, or null."""
        return np.append(each, np.array([null], dtype=each.dtype))[self.codes]

    def isin(self, *wanted: str) -> np.ndarray:
        found = pc.is_in(self.dictionary, pa.array(wanted, self.dictionary.type))
        return self.tokens(found.to_numpy(zero_copy_only=False), False)


def counted(spellings: Spellings, of: Callable[[str], str], ends: np.ndarray, chosen: np.ndarray):  # noqa: ANN201
    """(values, which, n, ends) of the distinct values of each run among the chosen tokens.

    A value is what ``of``, a form of lower case, makes of a spelling; spellings of
    one value are one.
    """
    made = pc.dictionary_encode(lowered(spellings.dictionary, of))
    values = made.dictionary
    codes = spellings.tokens(made.indices.to_numpy().astype("int64"), -1)
    runs = len(ends) - 1
    run = np.repeat(np.arange(runs), np.diff(ends))
    kept = chosen & (codes >= 0)
    width = max(len(values), 1)
    keys, n = np.unique(run[kept] * width + codes[kept], return_counts=True)
    of_run = np.bincount(keys // width, minlength=runs)
    return values, keys % width, n, bounds(of_run)


def depths(head: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Most hops from any token of each sentence to its root, by pointer doubling.

    ``head`` is a token's place in its sentence.  Every round doubles the
    distance that each token has looked up; a sentence of n tokens takes
    log2(n) rounds, and those that are done take no more part.
    """
    sizes = np.diff(ends)
    first = np.repeat(ends[:-1], sizes)
    size = np.repeat(sizes, sizes)
    nowhere = len(head)
    inside = (head >= 0) & (head < size)
    up = np.append(np.where(inside, first + head, nowhere), nowhere)
    hops = np.append((first + head != np.arange(nowhere)).astype("int64"), _NOWHERE)
    rounds = np.ceil(np.log2(np.maximum(size, 2))).astype("int64")
    active = np.arange(nowhere)
    for turn in range(int(rounds.max(initial=0))):
        active = active[(rounds[active] > turn) & (hops[up[active]] != 0)]
        if not len(active):
            break
        to = up[active]
        hops[active], up[active] = np.maximum(hops[active] + hops[to], _NOWHERE), up[to]
    found = np.zeros(len(sizes), dtype="int64")
    some = sizes > 0
    if some.any():
        found[some] = np.maximum(np.maximum.reduceat(hops[:-1], ends[:-1][some]), 0)
    return found


class Parsed:
    """The tokens of parsed units, sentence behind sentence."""

    def __init__(self, sents: pa.Array) -> None:
        in_units = sents.flatten()
        self.flat = in_units.flatten()
        self.sentence_ends = bounds(lengths(in_units))
        self.unit_sentences = bounds(lengths(sents))
        self.unit_ends = self.sentence_ends[self.unit_sentences]

    def field(self, name: str) -> pa.Array:
        return pc.struct_field(self.flat, name)

    def spellings(self, name: str) -> Spellings:
        return Spellings(self.field(name))

    def heads(self) -> np.ndarray:
        """Each token's head as a place in its sentence; a token without one is its own."""
        sizes = np.diff(self.sentence_ends)
        place = np.arange(len(self.flat)) - np.repeat(self.sentence_ends[:-1], sizes)
        head = self.field("head")
        known = head.is_valid().to_numpy(zero_copy_only=False)
        return np.where(known, pc.fill_null(head, 0).to_numpy(zero_copy_only=False), place)
