"""Learned partitions of vectors: a balanced cut of their neighbour graph, and a router.

All of this works on a bounded sample.
"""

from __future__ import annotations

import numpy as np

#: Neighbours of a vertex in the graph.
DEGREE = 12
#: Width of the router's hidden layer; rounds over the sample.
HIDDEN, EPOCHS, BATCH, RATE = 64, 40, 256, 2e-3


def neighbours(vectors: np.ndarray, degree: int) -> np.ndarray:
    """Rows of the nearest other vectors of each vector."""
    degree = min(degree, len(vectors) - 1)
    norms = (vectors * vectors).sum(axis=1)
    out = np.empty((len(vectors), degree), np.int64)
    for start in range(0, len(vectors), 1024):
        part = slice(start, start + 1024)
        far = norms - 2 * (vectors[part] @ vectors.T)
        far[np.arange(far.shape[0]), np.arange(start, start + far.shape[0])] = np.inf
        out[part] = np.argpartition(far, degree - 1, axis=1)[:, :degree]
    return out


def balanced_cut(near: np.ndarray, parts: int) -> np.ndarray:
    """The part of each vertex; sizes differ by at most one for each halving."""
    size = len(near)
    source = np.repeat(np.arange(size), near.shape[1])
    edges = np.concatenate([np.stack([source, near.ravel()], 1), np.stack([near.ravel(), source], 1)])
    part = np.zeros(size, np.int64)

    def halve(members: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            part[members] = first
            return
        local = np.full(size, -1)
        local[members] = np.arange(len(members))
        inner = local[edges]
        inner = inner[(inner >= 0).all(axis=1)]
        left = count // 2
        side = _bisect(inner, len(members), len(members) * left // count)
        halve(members[side == 0], first, left)
        halve(members[side == 1], first + left, count - left)

    halve(np.arange(size), 0, parts)
    return part


def _bisect(edges: np.ndarray, size: int, left: int) -> np.ndarray:
    """0 for ``left`` vertices and 1 for the others, with few edges between."""
    degree = np.maximum(1, np.bincount(edges[:, 0], minlength=size))
    # The second eigenvector of the walk on the graph, by power iteration.
    heavy = degree / degree.sum()
    value = np.random.default_rng(size).standard_normal(size)
    for _ in range(150):
        value -= (heavy * value).sum()
        spread = np.bincount(edges[:, 0], value[edges[:, 1]], size) / degree
        value = 0.5 * (value + spread)
        value /= np.linalg.norm(value) + 1e-12
    side = np.ones(size, np.int64)
    side[np.argsort(value, kind="stable")[:left]] = 0
    # Exchange the vertices that gain most, as long as the cut shrinks.
    for _ in range(20):
        other = np.bincount(edges[:, 0], side[edges[:, 1]] != side[edges[:, 0]], size)
        gain = 2 * other - degree
        zeros, ones = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        zeros, ones = zeros[np.argsort(-gain[zeros], kind="stable")], ones[np.argsort(-gain[ones], kind="stable")]
        pairs = min(len(zeros), len(ones))
        good = int(((gain[zeros[:pairs]] + gain[ones[:pairs]]) > 0).sum())
        good = min(good, max(1, pairs // 10)) if good else 0
        if not good:
            break
        changed = side.copy()
        changed[zeros[:good]], changed[ones[:good]] = 1, 0
        if (changed[edges[:, 0]] != changed[edges[:, 1]]).sum() >= other.sum():
            break
        side = changed
    return side


class Router:
    """A network of one hidden layer: how probable it is that neighbours lie in each part."""

    def __init__(self, vectors: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int):
        random = np.random.default_rng(5)
        self.middle, self.scale = vectors.mean(axis=0), vectors.std() + 1e-12
        inputs = self.inputs(vectors)
        # Where a vector's neighbours and itself lie.
        target = np.zeros((len(vectors), parts))
        np.add.at(target, (np.repeat(np.arange(len(vectors)), near.shape[1]), part[near].ravel()), 1.0)
        target[np.arange(len(vectors)), part] += 1.0
        target /= target.sum(axis=1, keepdims=True)
        width = vectors.shape[1]
        self.layers = [
            random.standard_normal((width, HIDDEN)) * (2 / max(1, width)) ** 0.5,
            np.zeros(HIDDEN),
            random.standard_normal((HIDDEN, parts)) * HIDDEN**-0.5,
            np.zeros(parts),
        ]
        first, second = [np.zeros_like(x) for x in self.layers], [np.zeros_like(x) for x in self.layers]
        step = 0
        for _ in range(EPOCHS):
            order = random.permutation(len(vectors))
            for start in range(0, len(order), BATCH):
                step += 1
                rows = order[start : start + BATCH]
                x, a, b = inputs[rows], self.layers[0], self.layers[2]
                hidden = np.maximum(0, x @ a + self.layers[1])
                wrong = (self._soft(hidden @ b + self.layers[3]) - target[rows]) / len(rows)
                behind = (wrong @ b.T) * (hidden > 0)
                slopes = [x.T @ behind, behind.sum(0), hidden.T @ wrong, wrong.sum(0)]
                for i, slope in enumerate(slopes):
                    slope = slope + 1e-4 * self.layers[i]
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    move = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                    self.layers[i] = self.layers[i] - RATE * move

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.middle) / self.scale

    @staticmethod
    def _soft(x: np.ndarray) -> np.ndarray:
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def probable(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each vector, the most probable first."""
        a, a0, b, b0 = self.layers
        logits = np.maximum(0, self.inputs(vectors) @ a + a0) @ b + b0
        return np.argsort(-logits, axis=1, kind="stable")[:, :count]


def learn(vectors: np.ndarray, parts: int, degree: int = DEGREE) -> Router:
    near = neighbours(vectors, degree)
    return Router(vectors, near, balanced_cut(near, parts), parts)


def probes_for(router: Router, sample: np.ndarray, asked: np.ndarray, parts: int, k: int, recall: float) -> int:
    """How many parts hold ``recall`` of the k nearest sampled vectors of vectors not learnt from."""
    home = router.probable(sample, 1)[:, 0]
    order = router.probable(asked, parts)
    at = np.empty_like(order)
    np.put_along_axis(at, order, np.arange(parts)[None, :].repeat(len(asked), 0), axis=1)
    far = (sample * sample).sum(axis=1) - 2 * asked @ sample.T
    k = min(k, len(sample))
    nearest = np.argpartition(far, k - 1, axis=1)[:, :k]
    reached = np.take_along_axis(at, home[nearest], axis=1)
    shares = [(reached < count).mean() for count in range(1, parts + 1)]
    return next(count for count, share in enumerate(shares, 1) if share >= recall)
