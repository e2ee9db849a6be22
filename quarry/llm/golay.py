"""The binary Golay code of length 23 as lookup tables, built from its rule.

Codewords are the multiples of the generator polynomial; the code is perfect,
so every 23-bit word is within 3 bits of exactly one of the 4,096 codewords.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for shift in range(LENGTH - CHECK_BITS - 1, -1, -1):
        if word >> (shift + CHECK_BITS) & 1:
            word ^= GENERATOR << shift
    return word


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of each value of the upper 12 bits, error masks by remainder).

    The masks of a remainder are all errors of at most 4 bits with it: one of
    at most 3 bits, padded with -1, or one of 3 and five of 4 bits."""
    high = np.array([_remainder(h << CHECK_BITS) for h in range(1 << 12)], np.int64)
    single = [_remainder(1 << b) for b in range(LENGTH)]
    masks: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for size in range(5):
        for bits in combinations(range(LENGTH), size):
            rem = 0
            for b in bits:
                rem ^= single[b]
            masks[rem].append(sum(1 << b for b in bits))
    width = max(map(len, masks))
    return high, np.array([m + [-1] * (width - len(m)) for m in masks], np.int64)


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Indices (0..4095) of the codewords within 4 bits of each 23-bit word:
    a row of 1 or 6 of them, padded with -1.

    Two words at most 2 bits apart always have one in common: let c be the
    codeword nearest to x.  If c is within 2 bits of x, it is within 4 of y.
    If it is 3 from x, it is at most 4 from y but for y = x plus two bits more
    away from c; then some codeword agrees with x - c in its three bits and
    with one of the two (any four places lie in a weight-7 codeword), which is
    4 from x and at most 4 from y."""
    high, masks = tables()
    rem = high[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))
    err = masks[rem]
    return np.where(err >= 0, (words[:, None] ^ err) >> CHECK_BITS, -1)
