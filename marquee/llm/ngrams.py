"""Hashed character n-grams of whole texts, in slices so that memory stays bounded."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SLICE = 1 << 19  # characters at once


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point: its lower-case form if a letter, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    for at in range(0x110000):
        char = chr(at)
        if char.isalpha():
            low = char.lower()
            out[at] = ord(low) if len(low) == 1 else at
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def buckets(text: str, lengths: tuple[int, ...], bits: int, fold: bool) -> Iterator[np.ndarray]:
    """Bucket numbers below 2**bits of all n-grams of the text; ``fold`` keeps letters only."""
    most = max(lengths)
    for start in range(0, max(len(text), 1), SLICE):
        codes = code_points(text[start : start + SLICE + most - 1])
        if fold:
            codes = letters()[codes]
        codes = codes.astype(np.uint32)
        last = start + SLICE >= len(text)
        for n in lengths:
            count = len(codes) - n + 1
            if not last:
                count = min(count, SLICE)
            if count <= 0:
                continue
            total = np.full(count, n, np.uint32)
            for at in range(n):
                total = (total ^ codes[at : at + count]) * np.uint32(0x9E3779B1)
                total ^= total >> np.uint32(15)
            yield total >> np.uint32(32 - bits)


def presence(text: str, lengths: tuple[int, ...], bits: int, scratch: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's letter n-grams, rising. ``scratch``: 2**bits zeros, kept zero."""
    for some in buckets(text, lengths, bits, True):
        scratch[some] = 1
    found = np.flatnonzero(scratch)
    scratch[found] = 0
    return found


def counts(text: str, lengths: tuple[int, ...], bits: int) -> np.ndarray:
    """How often each bucket occurs among the text's n-grams, any character counting."""
    total = np.zeros(1 << bits, np.float64)
    for some in buckets(text, lengths, bits, False):
        total += np.bincount(some, minlength=1 << bits)
    return total
