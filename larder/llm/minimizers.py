"""Content-defined sampling of byte strings: equal windows choose equal grams.

Of the grams of `GRAM` bytes inside a window of `WINDOW` bytes the one with the
smallest hash (the leftmost of equals) is the window's minimizer.  The choice
depends on the window's bytes alone, so equal windows, wherever they stand, have
the same gram at the same place inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW, GRAM = 100, 32
BLOCK = 1 << 20  # positions in one block: they take the low 20 bits beside the hash
SHIFT = np.uint64(20)
_RANDOM = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """64-bit hash of the `GRAM` bytes from each position on, by doubling (empty if `buf` is shorter)."""
    h, width = _RANDOM[buf], 1
    while width < GRAM:
        if len(h) <= width:
            return h[:0]
        h = h[:-width] * _ODD + (h[width:] ^ (h[width:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        width *= 2
    return h * _ODD


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    return np.minimum(v[:-(width - done)], v[width - done:]) if width > done else v


def runs_of(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, gram position, first window, last window) of each run of windows with one minimizer.

    `buf` holds texts one after the other, `ends` where each ends; windows do not cross texts.
    At most `BLOCK` bytes.
    """
    none = np.empty(0, np.int64)
    if len(buf) < WINDOW:
        return none.astype(np.uint64), none, none, none
    h = gram_hashes(buf)
    low = (np.uint64(1) << SHIFT) - np.uint64(1)
    least = _sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), WINDOW - GRAM + 1)
    bad = np.zeros(len(buf) + WINDOW + 1, np.int8)  # windows from here on run over the end of a text
    edges = np.minimum(ends[:-1], len(buf))
    np.add.at(bad, np.maximum(edges - WINDOW + 1, np.concatenate(([0], edges))[:-1] if len(edges) else edges), 1)
    np.add.at(bad, edges, -1)
    ok = np.flatnonzero(np.cumsum(bad[:len(least)]) == 0)
    if not len(ok):
        return none.astype(np.uint64), none, none, none
    p = (least[ok] & low).astype(np.int64)
    new = np.concatenate(([True], p[1:] != p[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(ok)])) - 1
    return h[p[first]], p[first], ok[first], ok[last]


def blocks_of(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of at most `BLOCK` bytes over texts of these sizes: (text number, from, to) arrays.

    A longer text goes in pieces that overlap by a window less one byte.
    """
    number, low, high, used = [], [], [], 0
    for k, n in enumerate(sizes.tolist()):
        at = 0
        while True:
            end = min(n, at + BLOCK - used) if n - at > BLOCK - used and used == 0 else n
            if end - at > BLOCK - used:
                yield np.array(number), np.array(low), np.array(high)
                number, low, high, used = [], [], [], 0
                continue
            number.append(k)
            low.append(at)
            high.append(end)
            used += end - at
            if end == n:
                break
            yield np.array(number), np.array(low), np.array(high)
            number, low, high, used = [], [], [], 0
            at = end - WINDOW + 1
    if number:
        yield np.array(number), np.array(low), np.array(high)
