"""The binary Golay code of length 23, which corrects three errors, and fuzzy keys made with it.

The code is perfect: every word of 23 bits lies within three bits of exactly one codeword, so a word
decodes to one of 4,096 indices.  A word's keys are the indices to which the word and its neighbours
at one bit decode.  Two words that differ in at most two bits have such a neighbour, or one of the
words itself, in common, and thus a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from folioworks.llm.common import by_value

LENGTH = 23
#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


class Golay:
    """Decoding by tables: remainder of both halves of a word, then the error that has this remainder."""

    def __init__(self) -> None:
        unit = [_remainder(1 << bit) for bit in range(LENGTH)]
        self.low = self._halves(unit[:12])
        self.high = self._halves(unit[12:])
        self.error = np.zeros(1 << 11, dtype=np.uint32)
        for weight in (1, 2, 3):
            for bits in combinations(range(LENGTH), weight):
                rest = 0
                for bit in bits:
                    rest ^= unit[bit]
                self.error[rest] = sum(1 << bit for bit in bits)

    @staticmethod
    def _halves(unit: list[int]) -> np.ndarray:
        table = np.zeros(1 << len(unit), dtype=np.uint32)
        for bit, rest in enumerate(unit):
            table[1 << bit : 2 << bit] = table[: 1 << bit] ^ rest
        return table

    def index(self, words: np.ndarray) -> np.ndarray:
        """The index of the nearest codeword: its twelve leading bits."""
        words = words.astype(np.uint32)
        rest = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[rest]) >> 11

    def around(self, words: np.ndarray, bits: int = LENGTH) -> np.ndarray:
        """Indices of each word (first column) and of its neighbours at one of the lowest ``bits`` bits."""
        flips = np.concatenate([np.zeros(1, np.uint32), np.uint32(1) << np.arange(bits, dtype=np.uint32)])
        return self.index(words.astype(np.uint32)[:, None] ^ flips[None, :])


by_value(__name__)
