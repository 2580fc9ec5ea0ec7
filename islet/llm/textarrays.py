"""Word and shingle hashes of a text as numpy arrays, for use inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C55 | 1
_INV = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 20

_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 4096)
        steps = np.full(size, base, U)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0xCA5A826395121157)
    return x ^ (x >> U(32))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_IS_GAP[data]
    turn = np.flatnonzero(np.diff(inside))
    return turn[0::2], turn[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, in pieces so that memory stays small for very long texts."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, "right")))
        lo, hi = int(starts[at]), int(ends[upto - 1])
        piece = data[lo:hi].astype(U) + U(1)
        sums = np.zeros(hi - lo + 1, U)
        np.cumsum(piece * powers(_BASE, hi - lo), out=sums[1:])
        s, e = starts[at:upto] - lo, ends[at:upto] - lo
        out[at:upto] = mix((sums[e] - sums[s]) * powers(_INV, hi - lo)[s] + (e - s).astype(U) * U(0xA0761D6478BD642F))
        at = upto
    return out


_FACTORS = [U(x) for x in (0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of the ASCII-lower-cased text; of fewer words, one for the whole sequence."""
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    hashes = word_hashes(data, *word_bounds(data))
    if not len(hashes):
        return hashes
    k = min(size, len(hashes))
    n = len(hashes) - k + 1
    total = np.zeros(n, U)
    for j in range(k):
        total += hashes[j : j + n] * _FACTORS[j % 5] * U(2 * (j // 5) + 1)
    return np.unique(mix(total + U(k)))
