"""Words as 64-bit hashes and rolling hashes of their n-grams, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from .chunks import Memo

_M = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of words (bytes), remembered while they are few."""

    def __init__(self, limit: int = 300_000):
        self.memo = Memo(lambda words: [xxhash.xxh64_intdigest(w, 42) for w in words], limit)

    def hashes(self, words: list[bytes]) -> np.ndarray:
        get = self.memo.want(set(words)).__getitem__
        return np.fromiter(map(get, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= _M
        out += words[k : k + n]
    return mix(out)


class Bloom:
    """A bit set of bounded size; it has every added hash, and few others while there is room."""

    BITS_EACH, MOST_BITS, PROBES = 64, 1 << 27, 6

    @classmethod
    def size(cls, n: int) -> int:
        return min(cls.MOST_BITS, 1 << max(12, (max(1, n) * cls.BITS_EACH - 1).bit_length()))

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    @classmethod
    def of(cls, hashes: np.ndarray, size: int) -> Bloom:
        own = cls(np.zeros(size // 64, np.uint64))
        for at in own._places(hashes):
            np.bitwise_or.at(own.bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        return own

    def _places(self, hashes: np.ndarray):
        step = mix(hashes + _M) | np.uint64(1)
        for k in range(self.PROBES):
            yield (hashes + np.uint64(k) * step) & self.mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of hashes that may have been added."""
        left = np.arange(len(hashes))
        for k in range(self.PROBES):
            if not len(left):
                break
            h = hashes[left]
            at = (h if k == 0 else h + np.uint64(k) * (mix(h + _M) | np.uint64(1))) & self.mask
            left = left[(self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return left
