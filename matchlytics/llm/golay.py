"""The perfect binary Golay code of 23 bits: 12 bits of message, every word within 3 errors of one codeword."""

from __future__ import annotations

import numpy as np

#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value of the code).
GENERATOR = 0b101011100011
LENGTH, CHECK = 23, 11


def _remainder(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK)), rest)
    return rest


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each high or low part of a word; the error of up to 3 bits that has a given remainder."""
    bits = 1 << np.arange(LENGTH)
    one = bits
    two = (bits[:, None] ^ bits[None, :])[np.triu_indices(LENGTH, 1)]
    three = np.unique((two[:, None] ^ bits[None, :]).ravel())
    three = three[[bin(x).count("1") == 3 for x in three]]
    errors = np.concatenate([[0], one, two, three])
    by_remainder = np.empty(1 << CHECK, np.int64)
    by_remainder[_remainder(errors)] = errors
    return _remainder(np.arange(1 << LENGTH - CHECK) << CHECK), by_remainder


HIGH, ERROR = _tables()


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (message) of the codeword nearest to each 23-bit word."""
    remainder = HIGH[words >> CHECK] ^ (words & (1 << CHECK) - 1)
    return (words ^ ERROR[remainder]) >> CHECK


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords nearest to each word or to a word one bit off: (row, index), each once.

    One index if the word lies within 2 bits of a codeword, six otherwise. Words that differ in one bit share an index.
    """
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)])
    found = np.sort(nearest(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, columns = np.nonzero(new)
    return rows, found[rows, columns]
