"""Spanning forests inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Union by least index; :meth:`add` takes pairs in bulk."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if np.array_equal(higher, self.up):
                return self.up
            self.up = higher

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            up = self.roots()
            a, b = up[i], up[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
