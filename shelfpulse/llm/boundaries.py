"""A compressed set of positions with select: containers of arrays, bitmaps and runs.

Positions are split into blocks of 65,536. A block that holds any has a container, in the
smallest of three forms: a sorted array of 16-bit numbers, a bitmap, or runs of neighbours. The
running sums of the containers' cardinalities tell which container holds the k-th position; a
select within that container tells the position.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
BITMAP_BYTES = BLOCK // 8

#: Bits set in each byte.
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)


class ArrayContainer:
    """Sorted 16-bit positions."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    @staticmethod
    def size(count: int) -> int:
        return 2 * count


class BitmapContainer:
    """A bit for each position of the block; a select counts the bits of its bytes."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(BLOCK, np.uint8)
        bits[low] = 1
        self.bits = np.packbits(bits, bitorder="little")

    def select(self, k: int) -> int:
        upto = np.cumsum(_ONES[self.bits])
        byte = int(np.searchsorted(upto, k, side="right"))
        before = int(upto[byte - 1]) if byte else 0
        inside = np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1], bitorder="little"))
        return byte * 8 + int(inside[k - before])


class RunContainer:
    """First positions and lengths of runs, with the running sums of the lengths."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first = first.astype(np.uint16)
        self.upto = np.cumsum(length, dtype=np.uint32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[run - 1]) if run else 0
        return int(self.first[run]) + k - before

    @staticmethod
    def size(runs: int) -> int:
        return 6 * runs


Container = ArrayContainer | BitmapContainer | RunContainer


def container(low: np.ndarray) -> Container:
    """The smallest form for sorted distinct positions of a block; at least one is given."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if RunContainer.size(len(starts)) < min(ArrayContainer.size(len(low)), BITMAP_BYTES):
        return RunContainer(low[starts], np.diff(starts, append=len(low)))
    if ArrayContainer.size(len(low)) <= BITMAP_BYTES:
        return ArrayContainer(low)
    return BitmapContainer(low)


class BoundarySet:
    """Containers by block, and the running sums of their cardinalities."""

    def __init__(self, blocks: Iterable[tuple[int, np.ndarray]]):
        """``blocks``: number and sorted distinct positions within it, in ascending order."""
        self.keys: list[int] = []
        self.containers: list[Container] = []
        counts: list[int] = []
        for key, low in blocks:
            if len(low):
                self.keys.append(key)
                self.containers.append(container(low))
                counts.append(len(low))
        self.upto = np.cumsum(counts, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The k-th smallest position, counted from zero."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[i - 1]) if i else 0
        return (self.keys[i] << BLOCK_BITS) + self.containers[i].select(k - before)


def line_ends(text: bytes) -> BoundarySet:
    """The last byte of each line of a text; a line ends with its line feed or the text."""

    def blocks():
        data = np.frombuffer(text, np.uint8)
        for begin in range(0, len(data), BLOCK):
            low = np.flatnonzero(data[begin : begin + BLOCK] == 10)
            if begin + BLOCK >= len(data) and data[-1] != 10:
                low = np.append(low, len(data) - 1 - begin)
            yield begin >> BLOCK_BITS, low

    return BoundarySet(blocks())
