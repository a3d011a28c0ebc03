"""Bounds of inner products from the mean and deviation of vector segments.

Over a segment of d components, the product of two vectors is d times the
product of their means plus the product of what deviates, which is at most the
product of the deviations (Cauchy-Schwarz). Means and deviations of a coarse
segment follow from those of its two halves, so only the finest are stored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Segments of the finest stored level; levels halve it down to one.
FINEST = 16
# Room for rounding: bounds are doubles, scores whole numbers.
SLACK = 1e-9
# Pairs looked at together.
PAIR_ROWS = 1 << 16
# One pair in so many is many.
DENSE = 16
# Integers up to this are exact in a double.
EXACT = 1 << 53
EDGE = 1 << 63


def as_rows(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros, the number of columns a multiple of ``FINEST``."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), -(-max(width, 1) // FINEST) * FINEST))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (root of the sum of squares) of every finest segment of every row."""
    parts = x.reshape(len(x), FINEST, -1)
    means = parts.mean(axis=2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))


def coarser(means: np.ndarray, deviations: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of segments twice as wide; ``width`` is that of the given ones."""
    a, b = means[:, ::2], means[:, 1::2]
    squares = deviations[:, ::2] ** 2 + deviations[:, 1::2] ** 2 + width * (a - b) ** 2 / 2
    return (a + b) / 2, np.sqrt(squares)


def levels(means: np.ndarray, deviations: np.ndarray, width: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(width of a segment, means, deviations) of all levels, the coarsest first."""
    out = [(width, means, deviations)]
    while out[0][1].shape[1] > 1:
        w, m, d = out[0]
        out.insert(0, (2 * w, *coarser(m, d, w)))
    return out


def products(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows a[i] of x and b[i] of y: all of them by matrices where many are asked for."""
    if len(a) * DENSE > len(x) * len(y):
        return (x @ y.T)[a, b]
    out = np.empty(len(a))
    for at in range(0, len(a), PAIR_ROWS):
        out[at : at + PAIR_ROWS] = np.einsum("ij,ij->i", x[a[at : at + PAIR_ROWS]], y[b[at : at + PAIR_ROWS]])
    return out


def exact_scores(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; beyond the range of a long they end at its ends."""
    largest = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if largest < EXACT:
        return products(x, y, a, b).astype(np.int64)
    whole = [sum(int(p) * int(q) for p, q in zip(x[i].tolist(), y[j].tolist())) for i, j in zip(a.tolist(), b.tolist())]
    return np.array([max(-EDGE, min(EDGE - 1, p)) for p in whole], np.int64)


def kth_largest(row: np.ndarray, value: np.ndarray, k: int, n_rows: int) -> np.ndarray:
    """Per row number the k-th largest of its values; the least there is where there are fewer. Row numbers come sorted."""
    out = np.full(n_rows, -np.inf if value.dtype.kind == "f" else -EDGE, value.dtype)
    bounds = np.searchsorted(row, np.arange(n_rows + 1)).tolist()
    for i, (start, end) in enumerate(zip(bounds, bounds[1:])):
        if end - start >= k:
            out[i] = np.partition(value[start:end], end - start - k)[end - start - k]
    return out


def candidates(
    xs: list, ys: list, allowed: np.ndarray, keep: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of x, row of y) that no level of bounds rules out.

    ``allowed`` says which pairs count at all; ``keep`` is given the rows of
    x, of y and the lower and upper bounds of the pairs left and says which may
    still matter. Bounds end where a long does. All pairs get the coarsest bounds, each finer level only
    those that are left.
    """
    a, b = np.nonzero(allowed)
    for (width, mx, dx), (_, my, dy) in zip(xs, ys):
        middle, swing = width * products(mx, my, a, b), products(dx, dy, a, b)
        room = swing + SLACK * (np.abs(middle) + swing) + SLACK
        left = keep(a, b, *np.clip([middle - room, middle + room], -float(EDGE), float(EDGE)))
        a, b = a[left], b[left]
    return a, b
