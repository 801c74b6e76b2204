"""Word hashes of whole texts in numpy: a few passes over the bytes of a block, no Python object per word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd, so it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes looked at in one go.
SEGMENT = 1 << 19


def byte_classes(separators: bytes, alone: bytes = b"") -> np.ndarray:
    """Class of each byte: 0 separates words, 2 and 1 form words of their own kind."""
    table = np.ones(256, np.uint8)
    table[list(separators)] = 0
    table[list(alone)] = 2
    return table


#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: Words between white space.
BY_SPACE = byte_classes(SPACES)
#: Runs of letters, digits and non-ASCII bytes; runs of other characters.
BY_KIND = byte_classes(SPACES, bytes(b for b in range(33, 127) if not chr(b).isalnum()))

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` begin, and a 64-bit hash of each (A-Z as a-z). Long data goes through in segments
    that end between words, so memory beside the result does not grow with it unless a single word does.
    """
    buffer = np.frombuffer(data, np.uint8)
    starts, hashes, begin = [], [], 0
    while begin < len(buffer):
        end = min(len(buffer), begin + SEGMENT)
        while end < len(buffer):
            gap = np.flatnonzero(classes[buffer[end : end + SEGMENT]] == 0)
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(buffer), end + SEGMENT)
        at, value = _words(buffer[begin:end], classes)
        starts.append(at + begin)
        hashes.append(value)
        begin = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def _words(buffer: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = classes[buffer]
    bounds = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(buffer)]))
    real = kind[bounds[:-1]] != 0
    start, end = bounds[:-1][real], bounds[1:][real]
    size = max(2 * SEGMENT, 1 << (len(buffer) - 1).bit_length())
    power, inverse = _powers(size) if size == 2 * SEGMENT else _powers.__wrapped__(size)
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((_LOWER[buffer] + np.uint64(1)) * power[: len(buffer)], out=total[1:])
    return start, mix((total[end] - total[start]) * inverse[start])


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts with a line feed between them, and where each begins."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return b"\n".join(texts), np.cumsum(lengths + 1) - lengths - 1


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` neighbouring words; the order of the words counts."""
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - n + 1 + i])
    return out
