"""Words of whole texts, found and hashed in bulk from the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes of a set; the sets used hold all bytes from 0x80, so no character is cut. Hashes are
64-bit polynomials over the bytes, the same for the same word wherever it stands. Two different words, or runs of words,
of one comparison share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = frozenset([0x20, *range(0x09, 0x0E)])
NOT_SPACE = np.array([b not in SPACES for b in range(256)])
LETTER_OR_DIGIT = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

SLICE_BYTES = 2 << 20
_HASHED_AT_ONCE = 1 << 20
#: glibc's; other C libraries have none
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a one-to-one mapping)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_LOWER_BYTES = np.arange(256)
_LOWER_BYTES[ord("A") : ord("Z") + 1] += 32
_LOWER_VALUES = _BYTE_VALUES[_LOWER_BYTES]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of consecutive texts. ``first[d]`` is the index of the first word of text d; the last entry counts all."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: What clears the things that an operator keeps in its worker from task to task.
kept_in_worker: list[Callable[[], None]] = []


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` bytes of text; a longer text comes alone and whole.

    Workers live on from stage to stage. Unless ``keep``, what another operator has kept in this one is let go first.
    """
    if not keep:
        let_go()
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end
    release_memory()


def let_go() -> None:
    """Clears what operators have kept in this worker."""
    while kept_in_worker:
        kept_in_worker.pop()()


def release_memory() -> None:
    """Gives back what the allocators hold: workers live on, and stages of other needs follow."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hashes of all words, some words at a time so that sums of powers stay small."""
    hashes = np.zeros(len(begin), np.uint64)
    word = 0
    while word < len(begin):
        base = begin[word]
        last = max(word + 1, int(np.searchsorted(end, base + _HASHED_AT_ONCE, "right")))
        here, after = begin[word:last] - base, end[word:last] - base
        n = int(after[-1])
        powers, inverses = _powers_up_to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[base : base + n]] * powers[:n], out=sums[1:])
        hashes[word:last] = mixed((sums[after] - sums[here]) * inverses[here])
        word = last
    return hashes


def text_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of whole texts, none of them empty."""
    return _word_hashes(data, offsets[:-1], offsets[1:], _BYTE_VALUES)


def find_words(column: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts; ``lower`` takes A-Z as a-z in the hashes."""
    data, offsets = text_bytes(column)
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = word_bytes[data]
    starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    across = cuts[inside[cuts] & inside[cuts + 1]]
    starts[across] = ends[across] = True
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    hashes = _word_hashes(data, begin, end, _LOWER_VALUES if lower else _BYTE_VALUES)
    return Words(hashes, begin, end, np.searchsorted(begin, offsets), data, offsets)


def runs_of_words(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for every k consecutive words; those that reach over the end of a text are the caller's to leave out."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= _BASE
        out += hashes[j : j + n]
    return mixed(out)


def run_starts(words: Words, k: int) -> np.ndarray:
    """Indices of the words at which k words of one text begin."""
    index = np.arange(len(words.hashes))
    return index[index + k <= np.repeat(words.first[1:], words.counts)]
