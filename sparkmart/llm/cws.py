"""Improved consistent weighted sampling of sparse weighted sets.

For hash j and element x with weight S, draw r, c ~ Gamma(2, 1) and beta ~ U(0, 1) from (x, j); then
t = floor(ln S / r + beta) and ln a = ln c - r (t - beta) - r.  The sample is the pair (x, t) with
the smallest a, and two sets share a sample with the probability of their weighted Jaccard
similarity.  The draws come from a pool of 2^14 per hash, chosen by the element's own bits; the
element's low bits break ties inside the pool.  Most elements have one weight in common, and for it
ln a and t are tabulated.
"""

from __future__ import annotations

import numpy as np

from .text import U, mix

_POOL_BITS = 14
_BLOCK = 1 << 16  # elements handled at once


class WeightedSampler:
    def __init__(self, n_hashes: int, usual_weight: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        shape = (n_hashes, 1 << _POOL_BITS)
        self.r = rng.gamma(2.0, size=shape).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, size=shape)).astype(np.float32)
        self.beta = rng.random(shape, dtype=np.float32)
        self.factor = rng.integers(0, 1 << 63, n_hashes, dtype=np.uint64) * U(2) + U(1)
        self.usual = np.float32(usual_weight)
        self.table = np.stack([self._sample(j, np.arange(shape[1]), np.log(self.usual))
                               for j in range(n_hashes)])

    def _sample(self, j: int, at: np.ndarray, log_weight) -> np.ndarray:
        """ln a in the upper 32 bits, in the order of its size, and t in the lower."""
        r, beta = self.r[j, at], self.beta[j, at]
        t = np.floor(log_weight / r + beta)
        log_a = self.log_c[j, at] - r * (t - beta) - r
        high = np.maximum(log_a + np.float32(100), np.float32(1e-3)).astype(np.float32)
        low = (t.astype(np.int64).astype(U) * U(0x9E3779B97F4A7C15)) >> U(32)
        return (high.view(np.uint32).astype(U) << U(32)) | low

    def signatures(self, h: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Samples of each set; sets are runs of (element, weight) by ``bounds``, none empty."""
        n, k = len(bounds) - 1, len(self.factor)
        out = np.full((n, k), np.iinfo(np.uint64).max, U)
        row = 0
        while row < n:
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _BLOCK, "right")) - 1)
            for lo in range(bounds[row], bounds[end], 8 * _BLOCK):  # a large set in several goes
                hi = min(lo + 8 * _BLOCK, bounds[end])
                full = row + np.flatnonzero(np.diff(np.clip(bounds[row:end + 1], lo, hi)))
                at = np.maximum(bounds[full], lo) - lo
                block = h[lo:hi]
                name = block & U(0xFFFFFFFF)
                odd = np.flatnonzero(weights[lo:hi] != self.usual)
                log_odd = np.log(weights[lo:hi][odd])
                for j in range(k):
                    pool = (block * self.factor[j]) >> U(64 - _POOL_BITS)
                    value = self.table[j][pool]
                    if len(odd):
                        value[odd] = self._sample(j, pool[odd], log_odd)
                    out[full, j] = np.minimum(out[full, j], np.minimum.reduceat(value ^ name, at))
            row = end
        return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each run of ``rows`` samples; the band's number is part of it."""
    n, k = signature.shape
    keys = np.tile(np.arange(k // rows, dtype=np.uint64) * U(0xD6E8FEB86659FD93), (n, 1))
    for i in range(rows):
        keys = mix(keys + signature[:, i::rows][:, :k // rows])
    return keys.view(np.int64)
