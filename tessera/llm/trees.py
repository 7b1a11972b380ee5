"""Gradient-boosted trees with a logistic loss, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Complete trees of one depth: per tree the features and bins of its inner nodes, then its leaves' values."""

    edges: list[np.ndarray]
    base: float
    depth: int
    split: np.ndarray  # (trees, 2^depth - 1)
    bin: np.ndarray
    value: np.ndarray  # (trees, 2^depth)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        b, rows, out = self.binned(x), np.arange(len(x)), np.full(len(x), self.base)
        for split, cut, value in zip(self.split, self.bin, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, split[at]] > cut[at])
            out += value[at - len(split)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, smooth: float = 1.0) -> Forest:
    """Fits trees level by level; each node takes the split of highest gain by sums over bins."""
    edges = []
    for k in range(x.shape[1]):
        seen = np.unique(x[:, k])
        middle = (seen[1:] + seen[:-1]) / 2
        edges.append(middle if len(middle) < BINS else np.unique(np.quantile(middle, np.linspace(0, 1, BINS - 1))))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    inner, width = 2**depth - 1, x.shape[1]
    forest = Forest(edges, float(np.log(share / (1 - share))), depth, np.zeros((trees, inner), np.int64), np.zeros((trees, inner), np.uint8), np.zeros((trees, inner + 1)))
    b, margin = forest.binned(x).astype(np.int64), np.full(len(x), forest.base)
    cell = b + np.arange(width) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h, at = y - p, p * (1 - p), np.zeros(len(x), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            flat = ((at - first)[:, None] * width * BINS + cell).ravel()
            sums = [np.bincount(flat, np.repeat(v, width), minlength=count * width * BINS).reshape(count, width, BINS).cumsum(axis=2) for v in (g, h)]
            gl, hl = sums
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth)
            best = gain.reshape(count, -1).argmax(axis=1)
            forest.split[t, first : first + count], forest.bin[t, first : first + count] = np.divmod(best, BINS)
            at = 2 * at + 1 + (b[np.arange(len(b)), forest.split[t, at]] > forest.bin[t, at])
        leaf = at - inner
        top, low = np.bincount(leaf, g, minlength=inner + 1), np.bincount(leaf, h, minlength=inner + 1)
        forest.value[t] = rate * top / (low + smooth)
        margin += forest.value[t][leaf]
    return forest
