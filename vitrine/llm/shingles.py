"""Word shingles of texts as sorted sets of 64-bit hashes, computed for whole batches at once.

Words are runs of anything but ASCII white space, A-Z in lower case. A shingle is five words in a row; a text with
fewer words is one shingle, a text without words has none. Hashes stand for shingles: two different shingles of one
pair of texts collide with a chance of about the product of their set sizes in 2**64.
"""

from __future__ import annotations

import numpy as np

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step & _MASK
    return out[:count]


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BYTE[_SPACE] = 0


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in an array of bytes. A word's hash depends on its bytes alone."""
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edges = np.concatenate([[0], edges])
    if len(data) and not space[-1]:
        edges = np.concatenate([edges, [len(data)]])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    # A word's hash is the sum over its bytes of a number for the byte times a power for its place.
    first, lengths = starts[0], ends - starts
    reach = np.diff(np.concatenate([starts, [len(data)]]))  # a word and the space after it, which adds nothing
    place = np.arange(first, len(data)) - np.repeat(starts, reach)
    terms = _BYTE[data[first:]] * _powers(_BASE, int(reach.max()))[place]
    return _mix(np.add.reduceat(terms, starts - first) + lengths.astype(np.uint64)), starts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    hashes, starts = word_hashes(joined)
    at = np.searchsorted(starts, bounds)
    rows = np.zeros(len(hashes), np.uint64)
    n = len(hashes)
    whole = max(0, n - WORDS + 1)
    for i in range(WORDS):  # five words in a row, wherever a text ends
        rows[:whole] = rows[:whole] * np.uint64(_BASE) + hashes[i : i + whole]
    rows = _mix(rows)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rows[a : b - WORDS + 1]))
        elif b > a:
            short = 0x51ED270B
            for h in hashes[a:b].tolist():
                short = (short * _BASE + h) & _MASK
            out.append(_mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
