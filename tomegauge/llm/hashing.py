"""Words and shingles of a text as 64-bit hashes, computed over whole byte arrays.

Two different words or shingles share a hash with probability 2^-64; nothing else is approximate here.
"""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once; a longer text is cut between words, so memory stays bounded.
CHUNK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (the finalizer of splitmix64)."""
    x = np.asarray(values, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit integers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _STEP)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = seeded(256, 1)
_BASE = int(seeded(1, 2)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd base modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def fold(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _chunk_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blank = np.empty(len(data) + 2, dtype=np.int8)
    blank[0] = blank[-1] = 1
    blank[1:-1] = _SPACE[data]
    edges = np.flatnonzero(np.diff(blank))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]), starts, ends


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word; a word is a run of bytes other than 0x20 and 0x09 to 0x0D."""
    array, at, parts = np.frombuffer(data, dtype=np.uint8), 0, []
    while at < len(array):
        end = min(at + CHUNK, len(array))
        while end < len(array) and not _SPACE[array[end]]:
            blanks = np.flatnonzero(_SPACE[array[end : end + CHUNK]])
            end = end + int(blanks[0]) if len(blanks) else min(end + CHUNK, len(array))
        hashes, starts, ends = _chunk_words(array[at:end])
        parts.append((hashes, starts + at, ends + at))
        at = end
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of width words; with fewer words, one for the whole sequence; none without words."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    take = min(width, len(hashes))
    total = np.zeros(len(hashes) - take + 1, dtype=np.uint64)
    for k, factor in enumerate(seeded(take, 3 + take)):
        total += hashes[k : k + len(total)] * (factor | np.uint64(1))
    return mix(total)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text, in ascending order of their hashes."""
    return np.unique(shingles(words(fold(text))[0], width))


def set_digest(values: np.ndarray) -> int:
    """A 64-bit digest of a set given in ascending order."""
    spots = powers(_BASE, len(values) + 1)[1:]
    total = int((mix(values + _STEP) * spots).sum(dtype=np.uint64)) + len(values)
    return int(mix(np.array([total % (1 << 64)], dtype=np.uint64))[0].astype(np.int64))
