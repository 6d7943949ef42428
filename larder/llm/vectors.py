"""What the two embedding operators share: usable vectors, rotations, chi-square quantiles, kd-trees."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_ROWS = 8192  # rows (of smallest hash) that space partitions are fitted on


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def rotation(dim: int, seed: int = 42) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def gaussian(dim: int, width: int, seed: int = 42) -> np.ndarray:
    """A dim x width matrix of standard normal (2-stable) projections."""
    return np.random.Generator(np.random.PCG64([seed, dim, width])).standard_normal((dim, width))


def chi_square_cdf(x: np.ndarray | float, width: int) -> np.ndarray:
    """Of an even number of degrees of freedom."""
    if width % 2:
        raise ValueError("an even number of projections is needed")
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, width // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, width: int) -> float:
    low, high = 0.0, 10.0 * width + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, width) < p else (low, mid)
    return high


def kd_boxes(points: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Boxes (low, high) that part the whole space, by median cuts of the widest axis, and the tree of cuts.

    A node is (axis, cut, left, right) or a leaf's number.  A box that cannot be cut (all its points are
    the same) stays one leaf.
    """
    dim = points.shape[1]
    low, high, count = [], [], 0

    def grow(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: int):
        nonlocal count
        if want > 1 and len(at) > 1:
            spread = points[at].max(axis=0) - points[at].min(axis=0)
            axis = int(np.argmax(spread))
            values = points[at, axis]
            cut = float(np.median(values))
            left = values <= cut
            if left.all():
                cut = float(np.max(values[values < cut])) if (values < cut).any() else cut
                left = values <= cut
            if not left.all():
                lo2, hi2 = lo.copy(), hi.copy()
                hi2[axis], lo2[axis] = cut, cut
                return [axis, cut, grow(at[left], lo, hi2, want // 2), grow(at[~left], lo2, hi, want - want // 2)]
        low.append(lo)
        high.append(hi)
        count += 1
        return count - 1

    tree = grow(np.arange(len(points)), np.full(dim, -math.inf), np.full(dim, math.inf), leaves)
    return np.array(low).reshape(-1, dim), np.array(high).reshape(-1, dim), tree


def leaf_of(points: np.ndarray, tree) -> np.ndarray:
    """The leaf of each point."""
    found = np.zeros(len(points), np.int32)

    def walk(node, at: np.ndarray) -> None:
        if not isinstance(node, list):
            found[at] = node
        elif len(at):
            axis, cut, left, right = node
            less = points[at, axis] <= cut
            walk(left, at[less])
            walk(right, at[~less])

    walk(tree, np.arange(len(points)))
    return found


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        x = points[:, k, None]
        gap = np.maximum(np.maximum(low[None, :, k] - x, x - high[None, :, k]), 0)
        total += gap * gap
    return total
