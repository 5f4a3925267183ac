"""Words and word shingles of Arrow text columns as 64-bit hashes, vectorised over the UTF-8 bytes.

A word is a run of bytes that are not separators. Every separator used here is an ASCII byte, and
no byte of a longer UTF-8 character is one, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

_PIECE = 1 << 20
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    _trim = None
_SEED = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _lowered() -> np.ndarray:
    table = np.arange(256)
    table[65:91] += 32
    return table


class Words:
    """How bytes form words: which are separators, after A-Z became a-z."""

    def __init__(self, separators: np.ndarray):
        self.separator = separators[_lowered()]
        values = mix(np.arange(1, 257, dtype=np.uint64) * _SEED) | np.uint64(1)
        self.value = np.where(self.separator, np.uint64(0), values[_lowered()])

    def hashes(self, data: np.ndarray, bounds: np.ndarray, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in order, and the text bounds in units of words.

        With ``first``, the hash is that of a word's first bytes, as many as that.

        ``bounds`` are the byte bounds of the texts, first to last. The buffer is worked through
        in pieces that end at separators, so one very long text needs no more memory per byte
        than many short ones.
        """
        base, end = int(bounds[0]), int(bounds[-1])
        hashes, starts, at = [], [], base
        while at < end:
            stop = min(end, at + _PIECE)
            limit = int(bounds[np.searchsorted(bounds, stop)])
            while stop < limit and not self.separator[data[stop]]:
                ahead = self.separator[data[stop : min(limit, stop + 4096)]]
                stop += int(ahead.argmax()) if ahead.any() else len(ahead)
            found, where = self._piece(data[at:stop], bounds, at, first)
            hashes.append(found)
            starts.append(where)
            at = stop
        all_starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        return all_hashes, np.searchsorted(all_starts, bounds)

    def _piece(self, data: np.ndarray, bounds: np.ndarray, at: int, most: int | None):
        in_word = ~self.separator[data]
        first = in_word.copy()
        first[1:] &= ~in_word[:-1]
        inner = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, at + len(data))] - at
        first[inner] |= in_word[inner]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        # Polynomial hash: value of each byte times a power by its place in the word.
        place = np.arange(len(data)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
        place = np.where(in_word, place, 0)
        powers = np.full(int(place.max()) + 1, np.uint64(0xD6E8FEB86659FD93), np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        weighted = self.value[data] * powers[place]
        if most is not None:
            weighted[place >= most] = 0
        return mix(np.add.reduceat(weighted, starts)), starts + at


def _table(is_separator) -> np.ndarray:
    return np.array([bool(is_separator(b)) for b in range(256)])


#: Words between ASCII white space.
SPACED = Words(_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D))
#: Runs of digits, ASCII letters and non-ASCII characters.
ALNUM = Words(_table(lambda b: not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def given_back() -> None:
    """Gives the system back what this Python worker's tasks have freed, so that an idle worker holds little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = 512, size: int = 4 << 20):
    """Parts of the batches with at most ``rows`` rows and about ``size`` bytes of text each; at the end, memory is given back."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, length in enumerate(lengths):
            if i > start and (i - start >= rows or total + length > size):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(length)
        if len(lengths) > start:
            yield batch.slice(start)
    given_back()


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash from several of equal length; their order matters."""
    total = np.zeros(len(parts[0]), np.uint64)
    for i, part in enumerate(parts):
        total += mix(part + np.uint64((2 * i + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
        total *= np.uint64(0x9FB21C651E98DF25)
    return mix(total)


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    return combine(*[words[i : i + n] for i in range(k)])


def shingle_sets(words: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct ``k``-word shingles; a shorter text is one shingle as a whole."""
    grams = rolling(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield combine(*[words[i : i + 1] for i in range(a, b)], np.full(1, b - a, np.uint64))
        else:
            yield words[:0]


def list_array(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:
    """Arrays of 64-bit numbers as a list column."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` and further columns."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])
