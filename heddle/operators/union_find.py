"""Union-find over arrays."""

from __future__ import annotations

import numpy as np


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least vertex of the component of each of ``n`` vertices, for edges (a[i], b[i]).

    A parent array with path compression, for all edges at once: each round hooks the greater of two roots to the least
    root it meets, then shortens all paths. Every component that has a lesser neighbour is absorbed, so rounds are few.
    """
    parent = np.arange(n)
    while len(a):
        a, b = parent[a], parent[b]
        open_ = a != b
        a, b = a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent
