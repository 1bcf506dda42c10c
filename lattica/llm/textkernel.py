"""Vectorised text kernels: words, lines and window hashes of many texts at once, straight from Arrow's buffers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Multiplier of the polynomial hashes; odd, so that it has an inverse modulo 2**64.
MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))
WINDOW_MULT = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i modulo 2**64 for i < n; kept between calls up to 2**21 of them."""
    global _powers, _inverse_powers
    if len(_powers) >= n:
        return _powers[:n], _inverse_powers[:n]
    p, q = np.full(n, MULT), np.full(n, INVERSE)
    p[0] = q[0] = 1
    p, q = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
    if n <= 1 << 21:
        _powers, _inverse_powers = p, q
    return p, q


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """UTF-8 bytes of several texts laid end to end; offsets has one more entry than there are texts."""

    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """From an Arrow string column; null counts as an empty text."""
        null = column.is_null().to_numpy(zero_copy_only=False)
        if column.null_count:
            column = column.fill_null("")
        n = len(column)
        if not n:
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64), null)
        wide = pa.types.is_large_string(column.type)
        _, offs, data = column.buffers()
        offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        return cls(raw[offsets[0] : offsets[-1]], offsets - offsets[0], null)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text numbers of the maximal runs of flagged bytes within each text."""
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:n]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return s, e, self.owner(s)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each byte position, in ascending order, belongs to."""
        return np.repeat(np.arange(len(self)), np.diff(np.searchsorted(at, self.offsets)))

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span."""
        n = len(self.data)
        p, q = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
        return mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64))


def windows(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start indices and 64-bit hashes of the windows of `width` neighbouring items of one owner. The owner goes into
    the hash, so equal hashes mean equal windows of the same owner."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, width):
        total = total * WINDOW_MULT + hashes[i : i + n]
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return at, mix(total[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(1)))


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and has it occurred earlier?"""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    more, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    more[order[1:]] |= same
    more[order[:-1]] |= same
    later[order[1:]] = same
    return more, later
