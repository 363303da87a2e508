"""Vectorised word and shingle hashing for batches of texts (runs inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+`` unless told otherwise. The separators are ASCII bytes, so words
can be cut on the UTF-8 bytes without decoding: no byte of a multi-byte
character equals a separator. All words of a batch are hashed at once with
numpy; a 64-bit word hash is a polynomial over random per-byte values, which
are drawn from a fixed seed, so every task and every rerun agrees.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = np.uint64(0x9E3779B97F4A7C13 | 3)  # odd, 3 mod 8: invertible, few factors of two in its powers less one
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte that is no letter, for words without digits and punctuation.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_MULT = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes hashed at a time; a longer text is a block of its own.
BLOCK_BYTES = 512 << 10


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """Hashes the words of batches of texts; keeps power tables of a block's size between calls."""

    def __init__(self, lower: bool = True, separator: np.ndarray = BLANK):
        self._byte = _BYTE_LOWER if lower else _BYTE
        self._separator = separator
        self._pow = np.ones(1, dtype=np.uint64)
        self._inv = np.ones(1, dtype=np.uint64)

    def words(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(hashes, bounds)``: text i has the words ``hashes[bounds[i]:bounds[i + 1]]``."""
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, dtype=np.uint8)
        n = len(buf)
        up, down = self._pow, self._inv
        if n > len(up):
            up, down = _powers(_BASE, n), _powers(_BASE_INV, n)
            if n <= 2 * BLOCK_BYTES:
                self._pow, self._inv = up, down
        sep = self._separator[buf]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        first = 0 if sep[0] else 1  # the buffer starts inside a word
        starts = np.concatenate(([0], edge[1::2])) if first else edge[0::2]
        ends = edge[0::2] if first else edge[1::2]
        prefix = np.empty(n + 1, dtype=np.uint64)
        prefix[0] = 0
        np.cumsum(self._byte[buf] * up[:n], out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * down[starts]
        hashes = mix64(value + (ends - starts).astype(np.uint64))
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        bounds = np.concatenate(([0], np.searchsorted(starts, text_ends)))
        return hashes, bounds


def blocks(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges ``[lo, hi)`` of texts of about ``BLOCK_BYTES`` together, at least one text each."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > BLOCK_BYTES:
            yield lo, i
            lo, held = i, 0
        held += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (``len(hashes) - n + 1`` of them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:m] * _MULT[0]
    for k in range(1, n):
        out = mix64(out) + hashes[k:k + m] * _MULT[k]
    return mix64(out)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; the whole sequence as one if it has fewer words; none without words."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    return np.unique(ngrams(words, min(n, len(words))))
