"""Keys of bit segments from the binary Golay code.

Every 23-bit word lies within 3 errors of exactly one codeword. With a parity bit the
word has an even number of ones and lies at distance 0 or 2 of one codeword of the
extended code, or at distance 4 of six. The numbers of these codewords are its keys:
two words that differ in at most 2 bits always share one.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

WORD, CHECK, DATA = 23, 11, 12
KEYS = 6
# Fixed value: the generator polynomial of the code.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(WORD - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders by data bits; by remainder, the errors that lead to codewords.

    The first is the one of plain decoding, with at most 3 bits. Where it has 3, five
    codewords lie at distance 4.
    """
    rest = np.array([_remainder(d << CHECK) for d in range(1 << DATA)], dtype=np.int64)
    unit = [_remainder(1 << b) for b in range(WORD)]
    table = np.full((1 << CHECK, KEYS), -1, dtype=np.int64)
    filled = np.zeros(1 << CHECK, dtype=np.int64)
    for weight in range(5):
        for bits in combinations(range(WORD), weight):
            at = 0
            for b in bits:
                at ^= unit[b]
            table[at, filled[at]] = sum(1 << b for b in bits)
            filled[at] += 1
    return rest, table


def codewords(words: np.ndarray) -> np.ndarray:
    """Up to six codeword numbers of each 23-bit word, nearest first, -1 where fewer.

    Words at distance 1 share the first number of either one with all of the other's.
    """
    rest, table = _tables()
    words = np.asarray(words, dtype=np.int64)
    errors = table[rest[words >> CHECK] ^ (words & ((1 << CHECK) - 1))]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK)
