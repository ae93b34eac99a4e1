"""Hashed character n-grams of whole texts, on flat code point arrays."""

from __future__ import annotations

import numpy as np

from cabinlens.llm.common import code_points

SPACE = np.uint32(32)


def _kept(codes: np.ndarray, extra: str, digits: bool) -> np.ndarray:
    """For each code point up to the largest present, whether it is kept: a
    letter, a digit if asked for, or in ``extra``."""
    present = np.flatnonzero(np.bincount(codes))
    table = np.zeros(int(codes.max()) + 1, bool)
    for i in present.tolist():
        c = chr(i)
        table[i] = c.isalpha() or (digits and c.isdigit()) or c in extra
    return table


def normalized(texts: list[str | None], digits: bool = False, extra: str = "") -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): lower-cased texts, each between two spaces, all other
    characters as spaces."""
    if not texts:
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    codes, offsets = code_points([f" {(t or '').lower()} " for t in texts])
    return np.where(_kept(codes, extra, digits)[codes], codes, SPACE), offsets


def grams(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position (the last n - 1 excluded)."""
    if len(codes) < n:
        return np.empty(0, np.int64)
    h = np.full(len(codes) - n + 1, 0x811C9DC5 + n, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = (h ^ codes[i:len(codes) - n + 1 + i]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
    return (h >> np.uint32(32 - bits)).astype(np.int64)
