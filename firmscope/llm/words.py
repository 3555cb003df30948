"""Words, windows and their hashes over Arrow batches, as NumPy arrays.

A *stretch* is the UTF-8 of some texts end to end, with the offsets of each
text, at most ``STRETCH`` bytes unless one text alone is longer. Work on a
stretch needs memory in proportion to it, whatever a batch holds.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

STRETCH = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Odd multipliers of the polynomial hashes, modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
OTHER = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; between them, memory that is no longer used goes back to the machine."""
    for batch in batches:
        yield batch
        trim()


def trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call outside glibc
        ctypes.CDLL(None).malloc_trim(0)


class Words(NamedTuple):
    """Words of a stretch: byte places, count per text, first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray


def stretches(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) in order; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + STRETCH, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = data[offsets[first] : offsets[last]]
        if lower:
            part = np.frombuffer(part.tobytes().translate(LOWER), np.uint8)
        yield first, last, part, offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes that are no ``space``; none spans two texts."""
    dark = ~space[data]
    begin, end = dark.copy(), dark.copy()
    begin[1:] &= ~dark[:-1]
    end[:-1] &= ~dark[1:]
    full = offsets[1:] > offsets[:-1]
    edges = offsets[:-1][full]
    begin[edges] = dark[edges]
    edges = offsets[1:][full] - 1
    end[edges] = dark[edges]
    starts = np.flatnonzero(begin)
    firsts = np.searchsorted(starts, offsets)
    return Words(starts, np.flatnonzero(end) + 1, np.diff(firsts), firsts)


def powers(n: int, base: int = BASE) -> np.ndarray:
    """1, base, base ** 2 ... modulo 2 ** 64."""
    out = np.ones(n, np.uint64)
    done, step = 1, base
    with np.errstate(over="ignore"):
        while done < n:
            out[done : 2 * done] = out[: min(done, n - done)] * np.uint64(step)
            done, step = 2 * done, step * step & _MASK
    return out


class Powers:
    """Powers of a base and of its inverse, as long as asked for so far."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n += -n % (1 << 16)
            self.up, self.down = powers(n, self.base), powers(n, self.inverse)
        return self.up, self.down


_POWERS = {base: Powers(base) for base in (BASE, OTHER)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """64-bit hash of values[start:end] for each span."""
    up, down = _POWERS[base].to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    out = mixed((sums[ends] - sums[starts]) * down[starts])
    return mixed(out ^ (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, found: Words, n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of n consecutive words, and the window's first word, of all windows inside one text."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(found.counts)), found.counts)
    firsts = np.flatnonzero(text[:size] == text[n - 1 :])
    return spans(hashes, firsts, firsts + n, base), firsts


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags between each two offsets."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def covered(firsts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n that begins at one of ``firsts``."""
    steps = np.zeros(size + n + 1, np.int32)
    np.add.at(steps, firsts, 1)
    np.add.at(steps, firsts + n, -1)
    return np.cumsum(steps[:size]) > 0


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 ... of all ranges, one after the other."""
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return at + np.arange(len(at))


class Remembered:
    """Values of words by hash, as many of each as it has, up to ``most`` words."""

    def __init__(self, kind: type, most: int) -> None:
        self.kind, self.most = kind, most
        self.forget()

    def forget(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.offsets, self.values = np.zeros(1, np.int64), np.zeros(0, self.kind)

    def rows_of(self, keys: np.ndarray, learn) -> np.ndarray:
        """Rows of sorted distinct keys; ``learn`` gives sizes and values for places of new ones."""
        if len(self.keys) + len(keys) > self.most:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            sizes, values = learn(np.flatnonzero(new))
            row = len(self.offsets) - 1 + np.arange(len(sizes))
            self.keys, self.rows = np.insert(self.keys, at[new], keys[new]), np.insert(self.rows, at[new], row)
            self.values = np.concatenate([self.values, values])
            self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes)))
            at = np.searchsorted(self.keys, keys)
        return self.rows[at]
