"""Character n-grams of texts as hashed sparse features."""

from __future__ import annotations

import numpy as np

from .text import U

FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
MAX_N = 3
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_PIECE = 1 << 18  # characters counted at once


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points; whatever is no letter counts as one kind of blank."""
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
    blank = (codes < 97) | ((codes > 122) & (codes < 170))
    codes[blank] = 32
    return codes


def counts(text: str) -> np.ndarray:
    """Occurrences of each hashed 1- to ``MAX_N``-gram of the whole text; ``FEATURES`` numbers."""
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, max(len(text), 1), _PIECE):
        codes = _codes(" " + text[at:at + _PIECE] + " ")
        gram = np.zeros(len(codes), U)
        for n in range(1, MAX_N + 1):
            # the gram of n characters that ends here: the one of n - 1 that ended before, and this
            gram = (np.concatenate([[U(0)], gram[:-1]]) + codes + U(n)) * _FACTORS[n - 1]
            usable = gram[n - 1:]
            if n == 1:
                usable = usable[codes != 32]
            total += np.bincount((usable >> U(64 - FEATURE_BITS)).astype(np.int64), minlength=FEATURES)
    return total
