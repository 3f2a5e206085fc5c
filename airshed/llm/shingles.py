"""Word shingles of a text as 64-bit hashes, computed with numpy.

Words are the maximal runs outside space and bytes 0x09-0x0D, after
lower-casing A-Z only. A word's hash is a polynomial over a fixed random
byte table, read from one prefix sum over the text's bytes, so the cost
per text is a few vectorised passes whatever its length. A shingle of
``width`` words combines its words' hashes in order and is mixed to 64
bits; equal shingles have equal hashes and different ones collide with
probability about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np

_SEED = 20_240_611
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POLY = 0xD1342543DE82EF95
_WORD = 0xA24BAED4963EE407
_MASK = (1 << 64) - 1

_BYTE = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (the table grows by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = np.uint64(base)
        have = np.cumprod(have, dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(raw: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """One 64-bit hash per maximal run of ``raw`` bytes marked ``inside``, in order."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * powers(_POLY, len(raw)), dtype=np.uint64, out=prefix[1:])
    # dividing by POLY**start makes a run's hash free of its place
    inverse = powers(pow(_POLY, -1, 1 << 64), len(raw))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * _MUL)


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word, in text order (empty for null or blank)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return run_hashes(raw, ~_SPACE[raw])


def letter_word_hashes(text: str | None) -> np.ndarray:
    """One hash per run of letters, lower-cased (every character beyond
    ASCII counts as a letter)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return run_hashes(raw, _LETTER[raw])


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes. Fewer than ``width`` words: the whole
    sequence as one shingle; no words: empty."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    span = min(width, n)
    total = np.full(n - span + 1, span * int(_MUL) & _MASK, dtype=np.uint64)
    factor = 1
    for k in range(span):
        factor = factor * _WORD & _MASK
        total += words[k:n - span + 1 + k] * np.uint64(factor)
    return np.unique(mix(total))
