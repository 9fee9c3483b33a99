"""A hash table from 32-bit keys to row numbers, asked for whole arrays of keys at a time."""

from __future__ import annotations

import numpy as np


class Lookup:
    """Open addressing with linear steps; built once, then only read."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        size = 1 << self.bits
        self.keys, self.rows, self.reach = np.zeros(size, np.uint32), np.full(size, -1, np.int32), 0
        rest, row = keys, np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(rest):
            free = np.flatnonzero(self.rows[slot] < 0)
            chosen = free[np.unique(slot[free], return_index=True)[1]]
            self.rows[slot[chosen]], self.keys[slot[chosen]] = row[chosen], rest[chosen]
            missed = self.rows[slot] != row
            rest, row, slot = rest[missed], row[missed], (slot[missed] + 1) & (size - 1)
            self.reach += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slot = self._slot(keys)
        rows = self.rows[slot]
        out = np.where(self.keys[slot] == keys, rows, -1)
        left = np.flatnonzero((out < 0) & (rows >= 0))
        for i in range(1, self.reach):
            if not len(left):
                break
            at = (slot[left] + i) & (len(self.keys) - 1)
            rows = self.rows[at]
            hit = (self.keys[at] == keys[left]) & (rows >= 0)
            out[left[hit]] = rows[hit]
            left = left[~hit & (rows >= 0)]
        return out


class Pieces:
    """Arrays of numbers by a pair of 64-bit keys, looked up and put together for whole arrays of keys.

    Both keys must agree, so that a piece is told from others by 128 bits. What is kept is bounded by `limit` bytes: when they
    are full no more is kept, until so many are missed that all is forgotten and begun anew.
    """

    def __init__(self, limit: int):
        self._limit = limit
        self.forget()

    def forget(self) -> None:
        self._mask, self._count, self._used, self._full = (1 << 12) - 1, 0, 0, False
        self._rows = np.full(self._mask + 1, -1, np.int32)
        self._keys, self._checks = np.zeros(1 << 10, np.uint64), np.zeros(1 << 10, np.uint64)
        self._starts, self._flat = np.zeros((1 << 10) + 1, np.int64), np.zeros(1 << 12, np.uint32)

    def __len__(self) -> int:
        return self._count

    @property
    def full(self) -> bool:
        """Whether something could not be kept."""
        return self._full

    @property
    def bytes(self) -> int:
        return sum(x.nbytes for x in (self._rows, self._keys, self._checks, self._starts, self._flat))

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The row of each pair of keys, -1 where it is not known."""
        out = np.full(len(keys), -1, np.int32)
        left, slot = np.arange(len(keys)), (keys & np.uint64(self._mask)).astype(np.int64)
        while len(left):
            rows = self._rows[slot]
            hit = (self._keys[rows] == keys[left]) & (self._checks[rows] == checks[left]) & (rows >= 0)
            out[left[hit]] = rows[hit]
            go_on = ~hit & (rows >= 0)
            left, slot = left[go_on], (slot[go_on] + 1) & self._mask
        return out

    def add(self, keys: np.ndarray, checks: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        """Pairs of keys that are not known yet, without repeats, how many numbers each has, and the numbers end to end."""
        upto = np.cumsum(counts)
        fit = min(self._limit // 96 - self._count, int(np.searchsorted(upto, self._limit // 8 - self._used, side="right")))
        self._full |= fit < len(keys)
        keys, checks, counts = keys[:fit], checks[:fit], counts[:fit]
        flat = flat[: int(upto[fit - 1]) if fit else 0]
        begin, end = self._count, self._count + len(keys)
        self._keys, self._checks = _grown(self._keys, end), _grown(self._checks, end)
        self._starts, self._flat = _grown(self._starts, end + 1), _grown(self._flat, self._used + len(flat))
        self._keys[begin:end], self._checks[begin:end] = keys, checks
        self._starts[begin + 1 : end + 1] = self._used + np.cumsum(counts)
        self._flat[self._used : self._used + len(flat)] = flat
        self._count, self._used = end, self._used + len(flat)
        if 2 * end > self._mask:
            self._mask = (1 << int(np.ceil(np.log2(4 * end)))) - 1
            self._rows, begin = np.full(self._mask + 1, -1, np.int32), 0
        self._insert(np.arange(begin, end, dtype=np.int32))

    def _insert(self, rows: np.ndarray) -> None:
        slot = (self._keys[rows] & np.uint64(self._mask)).astype(np.int64)
        while len(rows):
            free = np.flatnonzero(self._rows[slot] < 0)
            chosen = free[np.unique(slot[free], return_index=True)[1]]
            self._rows[slot[chosen]] = rows[chosen]
            missed = self._rows[slot] != rows
            rows, slot = rows[missed], (slot[missed] + 1) & self._mask

    def kept(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each row's numbers begin (one entry more than rows), and all numbers end to end."""
        return self._starts[: self._count + 1], self._flat[: self._used]


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy of at least twice its size where it is too small."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out
