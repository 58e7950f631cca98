"""Numpy kernels over many texts laid end to end as UTF-8 bytes: words, their hashes, hashes of substrings.

A substring's hash is polynomial modulo 2**64 with an odd base, so one running sum gives every substring:
``(P[end] - P[start]) * base**-start``. Bytes go in as random 64-bit numbers and the result is mixed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_CODES = np.random.default_rng(20240607).integers(0, 2**64, (2, 256), dtype=U)


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i up to n."""
    return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(n, b % 2**64, U)])) for b in (BASE, pow(BASE, -1, 2**64)))


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    return powers(size)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


class Substrings:
    """Hashes of substrings of one buffer."""

    def __init__(self, buf: np.ndarray, family: int = 0):
        self.up, self.down = powers_for(len(buf))
        codes = BYTE_CODES[family][buf]
        codes *= self.up[: len(buf)]
        self.sums = np.zeros(len(buf) + 1, U)
        np.cumsum(codes, out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.sums[ends] - self.sums[starts]
        h *= self.down[starts]
        h ^= (ends - starts).astype(U) * U(0xD6E8FEB86659FD93)
        return mix(h)

    def fixed(self, n: int) -> np.ndarray:
        """Of every substring of ``n`` bytes; unmixed."""
        h = self.sums[n:] - self.sums[:-n]
        h *= self.down[: len(h)]
        return h


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one line feed after each, and where each starts (one entry more than texts)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), at


def words(buf: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that do not stand ``between`` words; ``buf`` ends with such a byte."""
    dark = ~between[buf]
    edge = np.flatnonzero(dark[1:] != dark[:-1]) + 1
    if len(dark) and dark[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def windows(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` words in a row within one document, and where each starts in ``h``."""
    if len(h) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    m = len(h) - n + 1
    out = h[:m].copy()
    for i in range(1, n):
        out *= U(BASE)
        out += h[i : i + m]
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return mix(out[at]), at
