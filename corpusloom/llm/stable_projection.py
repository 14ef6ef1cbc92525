"""Nearest vectors by a few stable projections, a kd-tree over them and a chi-square stopping test.

Projected onto m Gaussian directions, the squared distance of two vectors at distance d is d^2 times a chi-square
variable with m degrees of freedom. So a search that has looked at all vectors within projected distance r, and
holds k within distance d, has missed one nearer than d with probability 1 - F(r^2 / d^2) at most, F being that
law's distribution: it stops when F is large enough.

Inner products become distances by one more component, sqrt(M^2 - |x|^2) for the stored vectors and 0 for
queries, M being the largest length: |x' - q'|^2 = M^2 + |q|^2 - 2 q.x.
"""

from __future__ import annotations

import math

import numpy as np


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number m of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


def directions(n_dims: int, m: int, seed: int) -> np.ndarray:
    """m Gaussian directions for vectors of ``n_dims`` components and the one that is added."""
    return np.random.default_rng(seed).standard_normal((n_dims + 1, m))


def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0))
    return np.c_[vectors, rest]


def split(points: np.ndarray, leaf: int) -> list[tuple[int, float, int]]:
    """A kd-tree as (axis, cut, left child); a leaf has axis -1 and its number in place of the child.

    Every node is cut at the median of its widest axis; points at the cut go right. The right child follows the
    left one. Points that are all alike stay one leaf.
    """
    tree: list[tuple[int, float, int]] = [(-1, 0.0, 0)]
    work, n_leaves = [(0, np.arange(len(points)))], 0
    while work:
        node, own = work.pop()
        if len(own) > leaf:
            inside = points[own]
            axis = int(np.ptp(inside, axis=0).argmax())
            values = inside[:, axis]
            cut = float(np.median(values))
            if not (values < cut).any():
                above = values[values > cut]
                cut = float(above.min()) if len(above) else cut
            below = values < cut
            if below.any():
                tree[node] = (axis, cut, len(tree))
                work += [(len(tree) + 1, own[~below]), (len(tree), own[below])]
                tree += [(-1, 0.0, 0), (-1, 0.0, 0)]
                continue
        tree[node] = (-1, 0.0, n_leaves)
        n_leaves += 1
    return tree


def leaf_of(tree: list[tuple[int, float, int]], points: np.ndarray) -> np.ndarray:
    """Each point's leaf."""
    out = np.zeros(len(points), np.int64)
    work = [(0, np.arange(len(points)))]
    while work:
        node, own = work.pop()
        axis, cut, child = tree[node]
        if axis < 0:
            out[own] = child
        elif len(own):
            below = points[own, axis] < cut
            work += [(child, own[below]), (child + 1, own[~below])]
    return out


def boxes(leaf: np.ndarray, points: np.ndarray, n_leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest coordinates of each leaf's points (infinities, swapped, for an empty one)."""
    low, high = np.full((n_leaves, points.shape[1]), np.inf), np.full((n_leaves, points.shape[1]), -np.inf)
    np.minimum.at(low, leaf, points)
    np.maximum.at(high, leaf, points)
    return low, high


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return np.einsum("ij,ij->i", gap, gap)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``box_distance`` of many points: a row each. Some points at a time, so that little is held."""
    out = np.empty((len(points), len(low)))
    some = max(1, (1 << 21) // max(1, low.size))
    for at in range(0, len(points), some):
        p = points[at:at + some, None, :]
        gap = np.maximum(np.maximum(low - p, p - high), 0.0)
        out[at:at + some] = np.einsum("qij,qij->qi", gap, gap)
    return out


class Searcher:
    """Incremental search over one block of vectors, many queries at a time."""

    LEAF = 256
    AT_ONCE = 512  # queries

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, project: np.ndarray):
        self.longest, self.project = longest, project
        points = augmented(vectors, longest) @ project
        tree = split(points, self.LEAF)
        leaf = leaf_of(tree, points)
        order = np.argsort(leaf, kind="stable")
        n_leaves = int(leaf.max()) + 1
        self.low, self.high = boxes(leaf, points, n_leaves)
        self.ids, self.vectors, self.start = ids[order], vectors[order], np.r_[0, np.cumsum(np.bincount(leaf, minlength=n_leaves))]

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, quantile: float, at_most: np.ndarray | None = None
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, inner product) of the k nearest found to each query, other than its own id.

        A query's leaves are visited by their projected distance, and all vectors of a leaf are verified; its search
        stops when the next leaf is so far that the test holds for the k-th distance held, or for ``at_most``, squared
        distances within which k vectors are known elsewhere. Queries that visit one leaf are one matrix product.
        """
        at_most = np.full(len(queries), np.inf) if at_most is None else at_most
        found = [self._some(at, query_ids[at:at + self.AT_ONCE], queries[at:at + self.AT_ONCE], k, quantile, at_most[at:at + self.AT_ONCE])
                 for at in range(0, len(queries), self.AT_ONCE)]
        return tuple(np.concatenate([f[i] for f in found]) for i in range(3))

    def _some(self, first: int, query_ids: np.ndarray, queries: np.ndarray, k: int, quantile: float, at_most: np.ndarray):
        away = box_distances(np.c_[queries, np.zeros(len(queries))] @ self.project, self.low, self.high)
        order = np.argsort(away, axis=1, kind="stable")
        away = np.take_along_axis(away, order, axis=1)
        lengths = np.einsum("ij,ij->i", queries, queries)
        shift, slack = self.longest**2 + lengths, 1e-9 * (self.longest * np.sqrt(lengths) + 1e-300)
        best = np.full((len(queries), k), -np.inf)  # the k largest products, as the matrix product has them, in no order
        kth = np.full(len(queries), -np.inf)
        mine = np.isin(self.ids, query_ids)
        pool, at, some = [], 0, 1
        going = np.arange(len(queries))
        while at < order.shape[1] and len(going):
            bound = np.minimum(at_most[going], np.where(np.isfinite(kth[going]), np.maximum(shift[going] - 2 * kth[going], 0.0), np.inf)) * quantile
            near = away[going, at:at + some] <= bound[:, None]
            going, near = going[near[:, 0]], near[near[:, 0]]
            who, nth = np.nonzero(near)
            who, leaves = going[who], order[going[who], at + nth]
            at, some = at + some, min(2 * some, 16)
            by_leaf = np.argsort(leaves, kind="stable")
            cuts = np.flatnonzero(np.diff(leaves[by_leaf])) + 1
            for group in np.split(by_leaf, cuts) if len(by_leaf) else ():
                own, a, b = who[group], self.start[leaves[group[0]]], self.start[leaves[group[0]] + 1]
                products = queries[own] @ self.vectors[a:b].T
                if mine[a:b].any():
                    products[query_ids[own][:, None] == self.ids[a:b]] = -np.inf
                some_near = np.flatnonzero(products.max(axis=1) >= kth[own] - slack[own])
                if not len(some_near):
                    continue
                own, products = own[some_near], products[some_near]
                held = np.concatenate([best[own], products], axis=1)
                best[own] = np.partition(held, held.shape[1] - k, axis=1)[:, -k:]
                kth[own] = best[own].min(axis=1)
                row, column = np.nonzero((products >= (kth[own] - slack[own])[:, None]) & (products > -np.inf))
                pool.append((own[row], a + column, products[row, column]))
        if not pool:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        who, rows, products = (np.concatenate([p[i] for p in pool]) for i in range(3))
        near = products >= kth[who] - slack[who]  # whatever rounding may put among the k
        who, rows = who[near], rows[near]
        # One product and one sum a row, so that equal vectors have equal scores to the last bit.
        scores = np.concatenate([(self.vectors[rows[i:i + 4096]] * queries[who[i:i + 4096]]).sum(axis=1) for i in range(0, len(rows), 4096)])
        ids = self.ids[rows]
        by = np.lexsort((ids, -scores, who))
        who, ids, scores = who[by], ids[by], scores[by]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        return who[rank < k] + first, ids[rank < k], scores[rank < k]
