"""The perfect binary Golay code [23, 12, 7] as a fuzzy hash of up to 23 bits.

Every 23-bit word lies within three bits of exactly one codeword. The indices of the codewords nearest
to all words within one bit of a word (one index, or six) have this property: words that differ in at
most two bits share an index, for a word between them is within one bit of both.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
# Fixed value: the generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders by low and high bits; for each remainder the error patterns and their number."""
    low = np.array([_remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.int64)
    bits = [_remainder(1 << b) for b in range(LENGTH)]
    patterns = np.zeros((1 << CHECKS, 6), np.int64)
    number = np.zeros(1 << CHECKS, np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            remainder = 0
            for place in places:
                remainder ^= bits[place]
            # A pattern of four bits is reached by one more flip, and only from three.
            if weight < 4 or patterns[remainder, 0].item().bit_count() == 3:
                patterns[remainder, number[remainder]] = sum(1 << place for place in places)
                number[remainder] += 1
    return low, high, patterns, number


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the nearest codeword (first column) and of the others reached by one flip.

    Returns an array of six columns and one that marks the columns that count.
    """
    low, high, patterns, number = _tables()
    remainder = low[words & 0xFFF] ^ high[words >> 12]
    codewords = words[:, None] ^ patterns[remainder]
    return codewords >> CHECKS, np.arange(6)[None, :] < number[remainder][:, None]
