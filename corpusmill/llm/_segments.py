"""Statistics of consecutive groups of a flat array; every group holds one element at least."""

from __future__ import annotations

import numpy as np


def starts(group: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)


def sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, at, axis=0) if len(at) else x[:0]


def spread(x: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Mean, deviation, least, greatest and median of each group."""
    mean = sums(x, at) / size
    square = sums((x - np.repeat(mean, size)) ** 2, at) / size
    return [mean, np.sqrt(square), np.minimum.reduceat(x, at), np.maximum.reduceat(x, at), *quantiles(x, at, size, (0.5,))]


def quantiles(x: np.ndarray, at: np.ndarray, size: np.ndarray, shares: tuple[float, ...]) -> list[np.ndarray]:
    """Linearly interpolated quantiles of each group."""
    s = x[np.lexsort((x, np.repeat(np.arange(len(at)), size)))]
    out = []
    for q in shares:
        place = q * (size - 1)
        low = np.floor(place).astype(np.int64)
        a, b = s[at + low], s[at + np.minimum(low + 1, size - 1)]
        out.append(a + (b - a) * (place - low))
    return out
