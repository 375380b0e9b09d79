"""Words and line parts of many texts at once, as numpy arrays over their joined bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_LETTER = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LETTER[SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 64, 2 * len(_POWERS))
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
    return _POWERS


def segment_hash(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each segment; segments begin at ``starts`` and end at white space or the next start."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    body = data[starts[0] :]
    starts = starts - starts[0]
    lengths = np.diff(np.append(starts, len(body)))
    place = np.arange(len(body), dtype=np.int64) - np.repeat(starts, lengths)
    terms = _LETTER[body]
    terms *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, starts))


@dataclass
class Words:
    data: np.ndarray  #: the texts' bytes, a line feed after each
    start: np.ndarray  #: of each word
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  #: of each text, the number of its first word; one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Of each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: list[bytes], lower: bool = True) -> Words:
    """Words of all texts; ``lower`` folds A-Z only. A word never spans two texts."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    space = SPACE[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start = np.flatnonzero(before & ~space)
    end = np.flatnonzero(space & ~before)
    return Words(data, start, end, segment_hash(data, start), np.searchsorted(start, offsets))
