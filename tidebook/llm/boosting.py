"""Gradient boosted trees for a yes or no, on a few numeric features.

A tree grows level by level from sums over all examples: the gradients, curvatures and numbers of
each node, feature and bin. Examples lie in blocks, wherever those are; only the sums, whose size
does not depend on the examples, come together. They are whole numbers, so it does not matter how
examples are dealt over blocks, or in which order blocks are added.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Bins of a feature at most, and the unit of gradients and curvatures.
BINS, UNIT = 32, 1 << 20


@dataclass
class Tree:
    """A complete tree as arrays: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray
    below: np.ndarray  #: goes left if the feature's value is at most this
    value: np.ndarray

    def node(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = self.feature[node] >= 0
            if not inner.any():
                return node
            left = x[np.arange(len(x)), np.maximum(self.feature[node], 0)] <= self.below[node]
            node = np.where(inner, 2 * node + 2 - left, node)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.node(x)]


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += tree(x)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


@dataclass
class Block:
    """Some of the examples; a row stands for all that are alike in their features."""

    bins: np.ndarray  #: (rows, features), see ``binned``
    n: np.ndarray  #: examples of each row
    yes: np.ndarray  #: those of them that are a yes


#: Sum of what a function gives for each block; 0 if there is none.
Total = Callable[[Callable[[Block], np.ndarray]], np.ndarray]

#: Shares of the examples at whose quantiles a feature is cut.
CUTS = np.linspace(0, 1, BINS + 1)[1:-1].tolist()


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)],
                    1).astype(np.uint8)


def _numbers(block: Block) -> np.ndarray:
    return np.array([block.yes.sum(), block.n.sum()], dtype=np.int64)


def _sums(block: Block, model: Boosted, tree: Tree, level: int) -> np.ndarray:
    """Gradients, curvatures and numbers by node of the level, feature and bin."""
    p = model.probability(block.bins)
    values = [np.rint(p * UNIT) * block.n - block.yes * UNIT, np.rint(p * (1 - p) * UNIT) * block.n,
              block.n]
    node = tree.node(block.bins) - (2 ** level - 1)
    own = np.flatnonzero(node >= 0)
    out = np.zeros((2 ** level, block.bins.shape[1], BINS, 3), dtype=np.int64)
    for k in range(block.bins.shape[1]):
        at = node[own] * BINS + block.bins[own, k]
        for i, v in enumerate(values):
            # Whole numbers below 2**53 add up exactly.
            out[:, k, :, i] = np.bincount(at, v[own], 2 ** level * BINS).reshape(-1, BINS)
    return out


def fit(total: Total, edges: list[np.ndarray], trees: int = 40, depth: int = 4, rate: float = 0.3,
        ridge: float = 1.0) -> tuple[Boosted, Boosted]:
    """Second-order boosting of the logistic loss over the bins between ``edges``.

    The same model twice: for values, and for their bins.
    """
    yes, n = np.zeros(2, dtype=np.int64) + total(_numbers)
    share = np.clip(yes / n if n else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    model, by_bin = Boosted(base, []), Boosted(base, [])
    if yes in (0, n):
        return model, by_bin
    size = 2 ** (depth + 1) - 1
    for _ in range(trees):
        tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
        bins = Tree(tree.feature, np.zeros(size), tree.value)

        def value(sums) -> float:
            return -rate * sums[0] / (sums[1] + ridge)

        for level in range(depth):
            first = 2 ** level - 1
            if level and (tree.feature[(first - 1) // 2:first] < 0).all():
                break
            sums = total(lambda b, t=bins, l=level: _sums(b, by_bin, t, l)) / [UNIT, UNIT, 1]
            for i, own in enumerate(sums, first):
                every = own[0].sum(axis=0)
                if not level:
                    tree.value[0] = value(every)
                if every[2] < 10:
                    continue
                best = 1e-6, -1, 0
                for k, e in enumerate(edges):
                    if not len(e):
                        continue
                    left = np.cumsum(own[k], axis=0)[:len(e)]
                    right = every - left
                    gain = (left[:, 0] ** 2 / (left[:, 1] + ridge)
                            + right[:, 0] ** 2 / (right[:, 1] + ridge)
                            - every[0] ** 2 / (every[1] + ridge))
                    at = int(gain.argmax())
                    if gain[at] > best[0]:
                        best = gain[at], k, at
                if best[1] >= 0:
                    _, k, at = best
                    tree.feature[i], tree.below[i], bins.below[i] = k, edges[k][at], at
                    left = own[k, :at + 1].sum(axis=0)
                    tree.value[2 * i + 1], tree.value[2 * i + 2] = value(left), value(every - left)
        model.trees.append(tree)
        by_bin.trees.append(bins)
    return model, by_bin
