"""What a task returns instead of all pairs: a forest over what is linked."""

from __future__ import annotations

import numpy as np


def spanning(edges: np.ndarray) -> np.ndarray:
    """Edges from each node to the smallest node it is connected with: as few as there are nodes.

    ``edges`` and the result have two rows, the ends.
    """
    if not edges.shape[1]:
        return np.empty((2, 0), np.int64)
    nodes, ends = np.unique(edges, return_inverse=True)
    x, y = ends.reshape(edges.shape)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[label[moved]]])
