"""Runs of bytes of one buffer: equality and checksums of many runs at once, eight bytes at a time."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import xxhash

#: Runs over this many bytes are worked on one by one.
_LONG = 256

# The five primes of the 64-bit xxHash and the reflected polynomial of CRC-32.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    )
)
_POLYNOMIAL = 0xEDB88320


def _crc_tables() -> np.ndarray:
    """Effect of each byte on a CRC-32 when 0 to 7 more bytes follow it."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLYNOMIAL), first >> 1).astype(np.uint32)
    tables = [first]
    for _ in range(7):
        tables.append((tables[-1] >> 8) ^ first[tables[-1] & 255])
    return np.stack(tables)


_TABLES = _crc_tables()


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class ByteRuns:
    """Runs of ``data`` from ``starts`` up to ``ends``."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        self.data, self.starts, self.lengths = data, starts, ends - starts
        padded = np.frombuffer(data + bytes(8), np.uint8)
        views = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data) + 1]
        self.lanes = np.ascontiguousarray(views).view("<u8").reshape(-1)

    def _one(self, k: int) -> bytes:
        return self.data[int(self.starts[k]) : int(self.starts[k] + self.lengths[k])]

    def _split(self, which: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Places in ``which`` of usual runs, and of the long ones."""
        long = self.lengths[which] > _LONG
        return np.flatnonzero(~long), np.flatnonzero(long).tolist()

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the runs ``a`` and ``b`` (numbers of runs), pairwise of the same length, hold the same bytes."""
        same = np.ones(len(a), bool)
        usual, long = self._split(a)
        for k in long:
            same[k] = self._one(a[k]) == self._one(b[k])
        live = usual[a[usual] != b[usual]]
        x, y, left = self.starts[a[live]], self.starts[b[live]], self.lengths[a[live]]
        while len(live):
            differ = self.lanes[x] ^ self.lanes[y]
            wrong = (differ << (np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8))) != 0
            same[live[wrong]] = False
            more = ~wrong & (left > 8)
            live, x, y, left = live[more], x[more] + 8, y[more] + 8, left[more] - 8
        return same

    def xxh64(self) -> np.ndarray:
        """The 64-bit xxHash, seed 0, of every run."""
        usual, long = self._split(np.arange(len(self.starts)))
        result = np.empty(len(self.starts), np.uint64)
        result[long] = [xxhash.xxh64_intdigest(self._one(k)) for k in long]
        at, left = self.starts[usual].copy(), self.lengths[usual].copy()
        h = np.full(len(usual), _P5)
        wide = np.flatnonzero(left >= 32)
        if len(wide):
            h[wide], at[wide] = self._stripes(at[wide], left[wide])
        h += left.astype(np.uint64)
        left = np.where(left >= 32, left % 32, left)
        live = np.flatnonzero(left >= 8)
        while len(live):
            h[live] = _rotl(h[live] ^ (_rotl(self.lanes[at[live]] * _P2, 31) * _P1), 27) * _P1 + _P4
            at[live] += 8
            left[live] -= 8
            live = live[left[live] >= 8]
        live = np.flatnonzero(left >= 4)
        h[live] = _rotl(h[live] ^ ((self.lanes[at[live]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at[live] += 4
        left[live] -= 4
        live = np.flatnonzero(left)
        while len(live):
            h[live] = _rotl(h[live] ^ ((self.lanes[at[live]] & np.uint64(0xFF)) * _P5), 11) * _P1
            at[live] += 1
            left[live] -= 1
            live = live[left[live] > 0]
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        result[usual] = h ^ (h >> np.uint64(32))
        return result

    def _stripes(self, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after all whole stripes of 32 bytes, and where what is left starts."""
        with np.errstate(over="ignore"):
            start = (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)
        state = [np.full(len(at), s) for s in start]
        live = np.arange(len(at))
        at, left = at.copy(), left.copy()
        while len(live):
            for k in range(4):
                state[k][live] = _rotl(state[k][live] + self.lanes[at[live] + 8 * k] * _P2, 31) * _P1
            at[live] += 32
            left[live] -= 32
            live = live[left[live] >= 32]
        h = _rotl(state[0], 1) + _rotl(state[1], 7) + _rotl(state[2], 12) + _rotl(state[3], 18)
        for s in state:
            h = (h ^ (_rotl(s * _P2, 31) * _P1)) * _P1 + _P4
        return h, at

    def crc32(self, which: np.ndarray) -> np.ndarray:
        """The unsigned CRC-32 of the runs with these numbers."""
        usual, long = self._split(which)
        result = np.empty(len(which), np.int64)
        result[long] = [crc32(self._one(which[k])) for k in long]
        at, left = self.starts[which[usual]].copy(), self.lengths[which[usual]].copy()
        c = np.full(len(usual), 0xFFFFFFFF, np.uint32)
        live = np.flatnonzero(left >= 8)
        while len(live):
            lane = self.lanes[at[live]] ^ c[live]
            after = _TABLES[7][lane & np.uint64(255)]
            for k in range(1, 8):
                after ^= _TABLES[7 - k][(lane >> np.uint64(8 * k)) & np.uint64(255)]
            c[live] = after
            at[live] += 8
            left[live] -= 8
            live = live[left[live] >= 8]
        live = np.flatnonzero(left)
        lane = self.lanes[at]  # the last seven bytes at most
        step = 0
        while len(live):
            byte = (lane[live] >> np.uint64(8 * step)).astype(np.uint32)
            c[live] = (c[live] >> 8) ^ _TABLES[0][(c[live] ^ byte) & 255]
            step += 1
            live = live[left[live] > step]
        result[usual] = c ^ np.uint32(0xFFFFFFFF)
        return result
