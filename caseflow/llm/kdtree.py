"""K-d trees over vectors of small whole numbers, with range search by L1 distance for many points at a time."""

from __future__ import annotations

import numpy as np


class KdTree:
    """Splits points at ``point[dim] < cut`` until a leaf has at most ``leaf`` points or all its points are equal.

    Each split takes the dimension whose cut above the mean comes nearest to halving the points. Boxes are those of
    the points it was built from, unless ``set_boxes`` gives others.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.dim, self.cut, self.children, self.leaf_of = [], [], [], []
        self.leaves: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), max(1, leaf))
        width = points.shape[1]
        self.low = np.zeros((len(self.dim), width), np.int32)
        self.high = np.zeros((len(self.dim), width), np.int32)
        self.set_boxes(np.array([points[x].min(axis=0) for x in self.leaves]), np.array([points[x].max(axis=0) for x in self.leaves]))

    def _node(self) -> int:
        for column, value in ((self.dim, -1), (self.cut, 0), (self.children, (-1, -1)), (self.leaf_of, -1)):
            column.append(value)
        return len(self.dim) - 1

    def _grow(self, points: np.ndarray, chosen: np.ndarray, leaf: int) -> None:
        open_nodes = [(self._node(), chosen)]
        while open_nodes:
            node, chosen = open_nodes.pop()
            own = points[chosen]
            cuts = np.floor(own.mean(axis=0)).astype(np.int64) + 1
            share = (own < cuts).mean(axis=0)
            dim = int(np.argmin(np.abs(share - 0.5)))
            if len(chosen) <= leaf or share[dim] == 1:
                self.leaf_of[node] = len(self.leaves)
                self.leaves.append(chosen)
                continue
            left = own[:, dim] < cuts[dim]
            self.dim[node], self.cut[node], self.children[node] = dim, int(cuts[dim]), (self._node(), self._node())
            open_nodes += [(self.children[node][0], chosen[left]), (self.children[node][1], chosen[~left])]

    def set_boxes(self, low: np.ndarray, high: np.ndarray) -> None:
        """The leaves' boxes; those of the other nodes follow."""
        for node in range(len(self.dim) - 1, -1, -1):  # children come after their parent
            if self.dim[node] < 0:
                self.low[node], self.high[node] = low[self.leaf_of[node]], high[self.leaf_of[node]]
            else:
                a, b = self.children[node]
                self.low[node], self.high[node] = np.minimum(self.low[a], self.low[b]), np.maximum(self.high[a], self.high[b])

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf into whose region each point falls."""
        found, open_nodes = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.dim[node] < 0:
                found[rows] = self.leaf_of[node]
            elif len(rows):
                left = points[rows, self.dim[node]] < self.cut[node]
                open_nodes += [(self.children[node][0], rows[left]), (self.children[node][1], rows[~left])]
        return found

    def reached(self, points: np.ndarray, radius: int):
        """``leaf, rows``: for each leaf, the points whose L1 distance to its box is at most ``radius``."""
        open_nodes = [(0, np.arange(len(points)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            own = points[rows]
            gap = np.maximum(self.low[node] - own, 0) + np.maximum(own - self.high[node], 0)
            rows = rows[gap.sum(axis=1) <= radius]
            if not len(rows):
                continue
            if self.dim[node] < 0:
                yield self.leaf_of[node], rows
            else:
                open_nodes += [(child, rows) for child in self.children[node]]
