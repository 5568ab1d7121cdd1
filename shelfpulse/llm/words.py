"""Hashes of words and shingles, made by numpy for many texts at once.

A word's 64-bit hash depends on its bytes after lower-casing A-Z and on its length. Texts
are worked on in slices cut between words, so that memory is bounded however long they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes that are hashed together.
SLICE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The published 64-bit finalizer of splitmix; a permutation of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, salt: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        start = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(start + np.uint64(salt)) | np.uint64(1)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    values = numbers(256, 1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[list(SPACES)] = 0
    return values


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[ord("A") : ord("Z") + 1] += 32
    return low


@lru_cache(maxsize=1)
def _is_word() -> np.ndarray:
    inside = np.ones(256, bool)
    inside[list(SPACES)] = False
    return inside


_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        out = np.full(max(n, 64), 0x9E3779B97F4A7C15 | 1, np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            _powers = np.cumprod(out, dtype=np.uint64)
    return _powers


def _hash_slice(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of one slice, where they begin, and their last two bytes."""
    inside = _is_word()[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, np.zeros(0, np.int64)
    size = end - begin
    low = _lower()
    suffix = low[data[end - 1]].astype(np.int64)
    suffix += np.where(size > 1, low[data[np.maximum(end - 2, 0)]].astype(np.int64) << 8, 0)
    power = _power_table(int(size.max()))
    # White space has value 0, so what lies between two words does not matter.
    data = data[begin[0] :]
    heads = begin - begin[0]
    inner = np.arange(len(data)) - np.repeat(heads, np.diff(np.append(heads, len(data))))
    np.minimum(inner, len(power) - 1, out=inner)
    values = _byte_values()[data]
    values *= power[inner]
    total = np.add.reduceat(values, heads)
    return mix(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), begin, suffix


def word_hashes(
    texts: Sequence[bytes], limit: int | None = None
) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts: their positions, all their word hashes, offsets into these, and the
    last two bytes of each word as a number. ``limit`` bytes are hashed together."""
    limit = limit or SLICE
    held: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > limit:
            if held:
                yield _together(texts, held)
                held, size = [], 0
            hashes, suffixes = _long(text, limit)
            yield [i], hashes, np.array([0, len(hashes)]), suffixes
            continue
        held.append(i)
        size += len(text) + 1
        if size >= limit:
            yield _together(texts, held)
            held, size = [], 0
    if held:
        yield _together(texts, held)


def _together(texts: Sequence[bytes], held: list[int]):
    data = np.frombuffer(b"\n".join([*(texts[i] for i in held), b""]), np.uint8)
    hashes, begin, suffixes = _hash_slice(data)
    heads = np.cumsum([0, *(len(texts[i]) + 1 for i in held)])
    return held, hashes, np.searchsorted(begin, heads), suffixes


def _long(text: bytes, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one long text, slice by slice; a word on an edge goes to the next slice."""
    out, at = [], 0
    data = np.frombuffer(text, np.uint8)
    while at < len(data):
        end = min(len(data), at + limit)
        if end < len(data):
            last = np.flatnonzero(~_is_word()[data[at:end]])
            if len(last):
                end = at + int(last[-1]) + 1
            else:  # one word fills the slice: go on to its end
                spaces = np.flatnonzero(~_is_word()[data[end:]])
                end = end + int(spaces[0]) + 1 if len(spaces) else len(data)
        hashes, _, suffixes = _hash_slice(data[at:end])
        out.append((hashes, suffixes))
        at = end
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def shingle_sets(texts: Sequence[bytes], width: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Groups of texts: their positions and each one's sorted distinct shingle hashes.

    A text of fewer words than ``width`` has one shingle, its whole sequence; one without
    words has none.
    """
    factors = numbers(width, 7)
    for held, hashes, offsets, _ in word_hashes(texts):
        n = len(hashes)
        total = np.zeros(max(0, n - width + 1), np.uint64)
        for j in range(width):
            total += hashes[j : j + len(total)] * factors[j]
        total = mix(total)
        sets = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            if b - a >= width:
                sets.append(np.unique(total[a : b - width + 1]))
            elif b > a:
                short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                sets.append(mix(np.array([short], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield held, sets
