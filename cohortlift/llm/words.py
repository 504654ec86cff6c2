"""Words, word hashes and shingle sets of whole Arrow text columns, without a Python object per word.

A text column's UTF-8 buffer is scanned with numpy a slice of rows at a time, so memory follows the
slice (or one very long text), not the column.  Separators and ``A``-``Z`` are single bytes in UTF-8,
which makes byte-wise splitting and lower-casing exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Separators of words: 0x20 and 0x09 to 0x0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: The same words in SQL and Java regular expressions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _byte_codes(fold_case: bool) -> np.ndarray:
    codes = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


_CODES = {True: _byte_codes(True), False: _byte_codes(False)}
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; kept for the slice size, made anew for longer texts."""
    held = _powers.get(name)
    if held is None or len(held) < size:
        held = np.full(max(size, _SLICE_BYTES), base, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if size <= 4 * _SLICE_BYTES:
            _powers[name] = held
    return held[:size]


def mix(value: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    value = value ^ (value >> np.uint64(30))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value = value ^ (value >> np.uint64(27))
    value = value * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


@dataclass
class Texts:
    """Some rows of a text column: bytes, and where each row's bytes begin (one more than rows)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def spans(self, breaks: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and the index of each row's first word (one more than rows)."""
        return runs(~breaks[self.data], self.offsets)

    def word_hashes(
        self, starts: np.ndarray, ends: np.ndarray, fold_case: bool = True
    ) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        size = len(self.data)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_CODES[fold_case][self.data] * _power(_ODD, "up", size), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power(_INVERSE, "down", size)[starts])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross rows, and each row's first run."""
    size = len(inside)
    first_bytes = offsets[:-1][offsets[:-1] < size]
    breaks = np.ones(size + 1, dtype=bool)
    breaks[1:size] = ~inside[: size - 1] if size else False
    breaks[first_bytes] = True
    starts = np.flatnonzero(inside & breaks[:size])
    breaks[:size] = ~inside
    breaks[first_bytes] = True
    breaks[size] = True
    ends = np.flatnonzero(inside & breaks[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = _SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a text column, nulls as empty texts, in slices of about ``limit`` bytes.

    The column's own buffers are read: only a slice that holds nulls is copied.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    edges, _ = _buffers(column)
    at = 0
    while at < len(column):
        upto = int(np.searchsorted(edges, edges[at] + limit, side="right")) - 1
        upto = min(max(upto, at + 1), len(column))
        part = column.slice(at, upto - at)
        offsets, data = _buffers(pc.fill_null(part, "") if part.null_count else part)
        offsets = offsets.astype(np.int64)
        yield Texts(at, data[offsets[0] : offsets[-1]], offsets - offsets[0])
        at = upto


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows of a string array begin and end, and the bytes they lie in; neither is a copy."""
    kind = np.int32 if pa.types.is_string(column.type) else np.int64
    _, offset_buffer, data_buffer = column.buffers()
    if not len(column):
        return np.zeros(1, dtype=kind), np.zeros(0, dtype=np.uint8)
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, dtype=np.uint8)


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words in each row."""
    parts = [np.diff(texts.spans()[2]) for texts in text_slices(column)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def shingles(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` lower-cased words, row after row, and each row's first one.

    A row of fewer words gives its whole sequence as one shingle, a row without words none.
    """
    starts, ends, first = texts.spans()
    hashes = texts.word_hashes(starts, ends)
    n_words = np.diff(first)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    if len(hashes) >= width:
        upto = len(hashes) - width + 1
        rolled = np.zeros(len(hashes), dtype=np.uint64)
        for step in range(width):
            rolled[:upto] += hashes[step : step + upto] * factors[step]
        rolled = mix(rolled)
    else:
        rolled = np.zeros(len(hashes), dtype=np.uint64)
    count = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    into = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=into[1:])
    out = rolled[np.repeat(first[:-1] - into[:-1], count) + np.arange(into[-1])]
    for size in range(1, width):
        rows = np.flatnonzero(n_words == size)
        if len(rows):
            value = np.full(len(rows), size, dtype=np.uint64) * _ODD
            for step in range(size):
                value += hashes[first[rows] + step] * factors[step]
            out[into[rows]] = mix(value ^ np.uint64(0x5851F42D4C957F2D))
    return out, into


def shingle_sets(texts: Texts, width: int) -> Iterator[np.ndarray]:
    """Each row's distinct shingle hashes, ascending."""
    values, first = shingles(texts, width)
    for row in range(texts.rows):
        part = np.sort(values[first[row] : first[row + 1]])
        if len(part) > 1:
            part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        yield part
