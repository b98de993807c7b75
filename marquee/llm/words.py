"""Words of a text as 32-bit numbers, and numbers of runs of words."""

from __future__ import annotations

import zlib

import numpy as np

_SEEN: dict[str, int] = {}
_MOST = 200_000  # words remembered per worker; more are hashed anew


def word_numbers(text: str) -> np.ndarray:
    """CRC-32 of each lower-case word between white space."""
    if len(_SEEN) > _MOST:
        _SEEN.clear()
    seen = _SEEN
    out = []
    for word in text.lower().split():
        number = seen.get(word)
        if number is None:
            number = seen[word] = zlib.crc32(word.encode())
        out.append(number)
    return np.array(out, np.uint64)


def shingles(numbers: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit number for each run of ``length`` words in text order; one for a shorter text."""
    if not len(numbers):
        return numbers
    length = min(length, len(numbers))
    count = len(numbers) - length + 1
    total = np.zeros(count, np.uint64)
    for at in range(length):
        total = (total + numbers[at : at + count] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value came before, in order: 0 for the first, 1 for the second ..."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lengths = np.diff(np.r_[start, len(values)])
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(start, lengths)
    return out
