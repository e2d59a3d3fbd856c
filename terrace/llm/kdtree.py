"""K-d trees over small integer vectors, searched by boxes for many queries at once (numpy)."""

from __future__ import annotations

import numpy as np

FAR = np.int16(1 << 14)
QUERIES = 4096


class KdTree:
    """A tree whose leaves hold at most ``leaf`` points, unless more are alike.

    ``order`` puts the points leaf by leaf; leaf ``i`` owns
    ``order[first[i] : first[i + 1]]``. With ``tight`` a node's box bounds its own
    points; without it boxes follow the cuts and cover all space, so that points
    the tree has never seen have a leaf too.
    """

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        dims = points.shape[1]
        self.children: list[tuple[int, int] | None] = []
        self.cuts: list[tuple[int, int] | None] = []
        lo, hi, self.leaf_of, owned = [], [], [], []
        everywhere = np.full(dims, -FAR), np.full(dims, FAR)
        todo = [(np.arange(len(points)), *everywhere, -1, 0)]
        while todo:
            own, low, high, parent, side = todo.pop()
            node = len(lo)
            if parent >= 0:
                both = list(self.children[parent])
                both[side] = node
                self.children[parent] = tuple(both)
            held = points[own]
            lo.append(held.min(axis=0) if tight and len(own) else low)
            hi.append(held.max(axis=0) if tight and len(own) else high)
            cut = self._cut(held) if len(own) > leaf else None
            self.cuts.append(cut)
            if cut is None:
                self.children.append(None)
                self.leaf_of.append(len(owned))
                owned.append(own)
                continue
            self.children.append((0, 0))
            self.leaf_of.append(-1)
            dim, at = cut
            below = held[:, dim] <= at
            left_high, right_low = high.copy(), low.copy()
            left_high[dim], right_low[dim] = at, at + 1
            todo.append((own[~below], right_low, high, node, 1))
            todo.append((own[below], low, left_high, node, 0))
        self.lo, self.hi = np.array(lo, np.int16), np.array(hi, np.int16)
        self.leaf_of = np.array(self.leaf_of)
        self.left = np.array([c[0] if c else -1 for c in self.children])
        self.right = np.array([c[1] if c else -1 for c in self.children])
        self.order = np.concatenate(owned)
        self.first = np.append(0, np.cumsum([len(o) for o in owned]))
        self.children = self.cuts = None
        self.n_leaves = len(owned)

    @staticmethod
    def _cut(held: np.ndarray) -> tuple[int, int] | None:
        """(dimension, value): values up to it go left; None if the points are alike."""
        low, high = held.min(axis=0), held.max(axis=0)
        if (low == high).all():
            return None
        best = None
        for dim in np.argsort(-held.var(axis=0), kind="stable")[:4]:
            if low[dim] == high[dim]:
                continue
            middle = int(np.median(held[:, dim]))
            for at in (middle - 1, middle):
                at = min(max(at, int(low[dim])), int(high[dim]) - 1)
                share = abs(int((held[:, dim] <= at).sum()) * 2 - len(held))
                if best is None or share < best[0]:
                    best = share, int(dim), at
        return best[1:]

    def search(self, queries: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for every leaf whose box a query reaches by ``up`` steps up and ``down`` steps down."""
        asked, leaves = [], []
        for at in range(0, len(queries), QUERIES):
            block = queries[at : at + QUERIES].astype(np.int16)
            query, node = np.arange(len(block)), np.zeros(len(block), np.int64)
            while len(query):
                point, lo, hi = block[query], self.lo[node], self.hi[node]
                near = (np.maximum(lo - point, 0).sum(axis=1) <= up) & (np.maximum(point - hi, 0).sum(axis=1) <= down)
                query, node = query[near], node[near]
                leaf = self.leaf_of[node]
                ended = leaf >= 0
                asked.append(query[ended] + at)
                leaves.append(leaf[ended])
                query, node = query[~ended], node[~ended]
                query, node = np.concatenate([query, query]), np.concatenate([self.left[node], self.right[node]])
        if not asked:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(asked), np.concatenate(leaves)

    def leaf_at(self, points: np.ndarray) -> np.ndarray:
        """The one leaf of each point (of a tree that is not tight)."""
        query, leaf = self.search(points, 0, 0)
        out = np.zeros(len(points), np.int64)
        out[query] = leaf
        return out
