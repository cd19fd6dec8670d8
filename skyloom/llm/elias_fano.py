"""Elias-Fano sequences and an n-gram trie level built of them, in one memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

_ONE = np.uint64(1)
BLOCK = 8  # words of the upper bits between two entries of the directory


class EliasFano:
    """A non-decreasing sequence of unsigned integers: low parts of whole bytes, high parts in unary, and a directory
    of the zeros before every ``BLOCK`` words. All queries are vectorised."""

    def __init__(self, low: np.ndarray, upper: np.ndarray, zeros: np.ndarray, bits: int, n: int) -> None:
        self.low, self.upper, self.zeros, self.bits, self.n = low, upper, zeros, bits, n

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        need = max(0, (top // max(1, n)).bit_length())
        bits = next(b for b in (8, 16, 32) if b >= need) if need <= 32 else 32 if need <= 40 else 48
        kind = {8: np.uint8, 16: np.uint16, 32: np.uint32, 48: np.uint64}[bits]
        high = (values >> np.uint64(bits)).astype(np.int64)
        words = ((int(high[-1]) if n else 0) + n + 2) // 64 + 1
        words = -(-words // BLOCK) * BLOCK
        at = high + np.arange(n)
        marks = np.zeros(words * 64, np.uint8)
        marks[at] = 1
        upper = np.packbits(marks, bitorder="little").view(np.uint64)
        per_block = BLOCK * 64 - np.bitwise_count(upper).reshape(-1, BLOCK).sum(1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(per_block)]).astype(np.int64)
        return cls((values & np.uint64((1 << bits) - 1)).astype(kind), upper, zeros, bits, n)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.upper, self.zeros]

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Position of the zero number ``k`` (from 0) in the upper bits."""
        block = np.searchsorted(self.zeros, k, side="right") - 1
        left = k - self.zeros[block]
        word = block * BLOCK
        for _ in range(BLOCK - 1):
            here = 64 - np.bitwise_count(self.upper[word]).astype(np.int64)
            on = left >= here
            left -= np.where(on, here, 0)
            word += on
        bits, at = ~self.upper[word], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            on = left >= ones
            left -= np.where(on, ones, 0)
            at += np.where(on, width, 0)
            bits = np.where(on, bits >> np.uint64(width), bits)
        return word * 64 + at

    def _before(self, high: np.ndarray) -> np.ndarray:
        """Elements whose high part is less than ``high``."""
        out = np.zeros(len(high), np.int64)
        some = high > 0
        out[some] = self._select0(high[some] - 1) + 1 - high[some]
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of every value, -1 where it is not in the sequence: the successor within its high part decides."""
        if not self.n or not len(values):
            return np.full(len(values), -1)
        values = np.asarray(values, np.uint64)
        last = int(self.zeros[-1])
        high = np.minimum(values >> np.uint64(self.bits), np.uint64(last - 1)).astype(np.int64)
        low = (values & np.uint64((1 << self.bits) - 1)).astype(self.low.dtype)
        a, b = np.minimum(self._before(high), self.n), np.minimum(self._before(high + 1), self.n)
        end = b.copy()
        while (go := a < b).any():
            mid = (a + b) >> 1
            less = go & (self.low[np.minimum(mid, self.n - 1)] < low)
            a, b = np.where(less, mid + 1, a), np.where(go & ~less, mid, b)
        at = np.minimum(a, self.n - 1)
        same = (a < end) & (self.low[at] == low) & ((values >> np.uint64(self.bits)).astype(np.int64) == high)
        return np.where(same, at, -1)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(self.upper.view(np.uint8), bitorder="little"))[:self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)) | self.low.astype(np.uint64)


class Quantised:
    """Real numbers in 16-bit steps between the least and the greatest."""

    def __init__(self, codes: np.ndarray, least: float, step: float) -> None:
        self.codes, self.least, self.step = codes, least, step

    @classmethod
    def build(cls, x: np.ndarray) -> Quantised:
        least, most = (float(x.min()), float(x.max())) if len(x) else (0.0, 0.0)
        step = (most - least) / 65535 or 1.0
        return cls(np.rint((x - least) / step).astype(np.uint16), least, step)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.least + self.step * self.codes[at]


class Trie:
    """Two levels: words, and below each word the contexts it was seen after.

    Level 1 has the sorted word keys, monotone pointers to the first child of each word, and per word the value of an
    unseen context. Level 2 has the children, each a context number relative to its word, kept monotone over the level
    by a step of ``width`` per word, and their values. All of it lies in one file that is mapped, not loaded.
    """

    def __init__(self, words: np.ndarray, unseen: np.ndarray, parent: np.ndarray, child: np.ndarray, value: np.ndarray,
                 width: int) -> None:
        self.width = np.uint64(max(1, width))
        self.words = EliasFano.build(words)
        self.pointers = EliasFano.build(np.searchsorted(parent, np.arange(len(words) + 1)))
        self.children = EliasFano.build(parent.astype(np.uint64) * self.width + child.astype(np.uint64))
        self.unseen, self.value = Quantised.build(unseen), Quantised.build(value)
        self._map()

    def _map(self) -> None:
        with tempfile.TemporaryFile() as file:  # without a name: the space goes with the map
            places = []
            for owner, name in [*((o, n) for o in (self.words, self.pointers, self.children) for n in ("low", "upper", "zeros")),
                                (self.unseen, "codes"), (self.value, "codes")]:
                data = getattr(owner, name)
                file.write(b"\0" * (-file.tell() % 8))
                places.append((owner, name, file.tell(), data.dtype, len(data)))
                data.tofile(file)
            file.write(b"\0" * 8)
            file.flush()
            for owner, name, at, kind, n in places:
                if n:
                    setattr(owner, name, np.memmap(file, kind, "r", at, (n,)))

    def codes(self, word: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each (number of a word on level 1, context) the code of its value and True, or the code of the word's unseen
        value and False where it has no such child."""
        first = self.pointers.values().astype(np.int64)
        out, seen = self.unseen.codes[word], np.zeros(len(word), bool)
        some = np.flatnonzero((first[word + 1] > first[word]) & (child >= 0))
        at = self.children.find(word[some].astype(np.uint64) * self.width + child[some].astype(np.uint64))
        out[some[at >= 0]] = self.value.codes[at[at >= 0]]
        seen[some[at >= 0]] = True
        return out, seen

    def score(self, word: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Value of each (number of a word on level 1, context), the unseen value of the word where it has no such child."""
        codes, seen = self.codes(word, child)
        return np.where(seen, self.value.least + self.value.step * codes, self.unseen.least + self.unseen.step * codes)
