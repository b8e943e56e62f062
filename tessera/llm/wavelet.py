"""Wavelet matrix over small whole numbers: succinct bit-planes with rank and select.

The planes hold the bits of a sequence from the highest to the lowest; before each next
plane the sequence is stably parted, zeros first.  Rank (ones before a place) and select
(place of the k-th bit) on the planes answer, in as many steps as there are planes: the
value at a place, how often a value occurs before a place, and where its k-th occurrence
is.  All of them take arrays of questions.  Planes are cut into blocks that are fetched when
a question touches them, so that a file need not be read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bits of a block of a plane.
BLOCK = 1 << 18


def pack(bits: np.ndarray) -> np.ndarray:
    """Booleans as little-endian 64-bit words."""
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)]).view("<u8")


def build(values: np.ndarray, n_planes: int) -> tuple[list[np.ndarray], list[int]]:
    """Words of each plane, highest bit first, and the number of zeros in each."""
    planes, zeros = [], []
    for level in range(n_planes - 1, -1, -1):
        words = pack((values & values.dtype.type(1 << level)).astype(bool))
        mask = pa.Array.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(words)])
        column = pa.array(values)
        ones = pc.filter(column, mask).to_numpy()
        values = np.concatenate([pc.filter(column, pc.invert(mask)).to_numpy(), ones])
        planes.append(words)
        zeros.append(len(values) - len(ones))
    return planes, zeros


def count_ones(words: np.ndarray) -> int:
    return int(np.bitwise_count(words).sum())


class Bits:
    """Rank and select inside one block."""

    def __init__(self, words: np.ndarray):
        self.words = np.append(words, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def get(self, pos: np.ndarray) -> np.ndarray:
        return ((self.words[pos >> 6] >> (pos & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)

    def rank(self, pos: np.ndarray) -> np.ndarray:
        word, low = pos >> 6, (np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        before = self.before if bit else 64 * np.arange(len(self.before)) - self.before
        word = np.searchsorted(before, k, "right") - 1
        left = k - before[word]
        rest = self.words[word] if bit else ~self.words[word]
        pos = word << 6
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(rest & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= ones
            left = left - ones * up
            pos = pos + half * up
            rest = rest >> (np.uint64(half) * up.astype(np.uint64))
        return pos


class Plane:
    """A plane of ``n`` bits in blocks of ``size``; ``ones`` are those of each block, ``fetch``
    gives the words of a block."""

    def __init__(self, n: int, ones: Sequence[int], fetch: Callable[[int], np.ndarray], size: int = BLOCK):
        self.size, self.fetch, self.blocks = size, fetch, {}
        self.ones = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])
        self.zeros = np.minimum(size * np.arange(len(self.ones)), n) - self.ones

    @classmethod
    def of(cls, n: int, words: np.ndarray) -> Plane:
        """A plane in memory: one block."""
        return cls(n, [count_ones(words)], lambda b: words, max(64 * len(words), 1))

    def block(self, b: int) -> Bits:
        if b not in self.blocks:
            self.blocks[b] = Bits(self.fetch(b))
        return self.blocks[b]

    def _by_block(self, block: np.ndarray, answer) -> np.ndarray:
        if len(self.ones) == 2:
            return answer(0, slice(None))
        out = np.zeros(len(block), np.int64)
        for b in np.unique(block).tolist():
            rows = np.flatnonzero(block == b)
            out[rows] = answer(b, rows)
        return out

    def get(self, pos: np.ndarray) -> np.ndarray:
        return self._by_block(pos // self.size, lambda b, rows: self.block(b).get(pos[rows] - b * self.size))

    def rank(self, pos: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = np.minimum(pos // self.size, len(self.ones) - 2)
        return self._by_block(block, lambda b, rows: self.ones[b] + self.block(b).rank(pos[rows] - b * self.size))

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the k-th (from 0) such bit."""
        before = self.ones if bit else self.zeros
        block = np.searchsorted(before, k, "right") - 1
        return self._by_block(block, lambda b, rows: b * self.size + self.block(b).select(k[rows] - before[b], bit))


class WaveletMatrix:
    def __init__(self, n: int, planes: Sequence[Plane], zeros: Sequence[int]):
        self.n, self.planes, self.zeros = n, list(planes), list(zeros)

    @classmethod
    def of(cls, values: np.ndarray, n_planes: int) -> WaveletMatrix:
        words, zeros = build(values, n_planes)
        return cls(len(values), [Plane.of(len(values), w) if len(values) else Plane(0, [0], lambda b: np.zeros(0, "<u8")) for w in words], zeros)

    def _bits(self, value: int):
        top = len(self.planes) - 1
        return [(plane, zeros, value >> (top - i) & 1) for i, (plane, zeros) in enumerate(zip(self.planes, self.zeros))]

    def access(self, pos) -> np.ndarray:
        """Values at the places."""
        pos = np.asarray(pos, np.int64)
        value = np.zeros(len(pos), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(pos), plane.rank(pos)
            value = value << 1 | bit
            pos = np.where(bit, zeros + ones, pos - ones)
        return value

    def _down(self, value: int, pos: np.ndarray) -> np.ndarray:
        for plane, zeros, bit in self._bits(value):
            ones = plane.rank(pos)
            pos = zeros + ones if bit else pos - ones
        return pos

    def rank(self, value: int, pos) -> np.ndarray:
        """Occurrences of the value before each place."""
        pos = np.asarray(pos, np.int64)
        if value < 0 or value >> len(self.planes):
            return np.zeros(len(pos), np.int64)
        ends = self._down(value, np.append(pos, 0))
        return ends[:-1] - ends[-1]

    def select(self, value: int, k) -> np.ndarray:
        """Place of the k-th (from 0) occurrence; there must be one."""
        pos = self._down(value, np.zeros(1, np.int64))[0] + np.asarray(k, np.int64)
        for plane, zeros, bit in reversed(self._bits(value)):
            pos = plane.select(pos - zeros if bit else pos, bit)
        return pos

    def values(self, dtype) -> np.ndarray:
        """The whole sequence, put together from the lowest plane up."""
        out = np.zeros(self.n, dtype)
        for i, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            words = [plane.fetch(b) for b in range(len(plane.ones) - 1)]
            bits = np.unpackbits(np.concatenate(words).view(np.uint8), bitorder="little", count=self.n).view(bool)
            before = np.empty_like(out)
            np.place(before, ~bits, out[:zeros])
            if zeros < self.n:
                np.place(before, bits, out[zeros:] | dtype(1 << i))
            out = before
        return out
