"""K-d trees over letter counts, for words that are one edit apart.

A replaced letter takes one from one count and adds one to another, an added letter adds one.
So a search carries what may still go up and what may still go down, and at each split it
enters the far side only where the count lies at the split and the change is left: that
prunes every box farther than the edit allows.  Distances are checked for whole leaves at
once, and the letters' order last.

A tree is ``(dimension, bound, left, right)``, where counts up to the bound go left, or a leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

LETTERS = 26
# Letters beyond a-z share these dimensions: that can only bring words closer.
OTHERS = 6
DIMENSIONS = LETTERS + OTHERS

LEAF_POINTS = 48
# Code points that are compared at a time.
AT_ONCE = 1 << 22


def codes(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length)


def letter_counts(matrix: np.ndarray) -> np.ndarray:
    plain = (matrix >= ord("a")) & (matrix <= ord("z"))
    dimension = np.where(plain, matrix - ord("a"), LETTERS + matrix % OTHERS).astype(np.int64)
    dimension += np.arange(len(matrix))[:, None] * DIMENSIONS
    flat = np.bincount(dimension.ravel(), minlength=len(matrix) * DIMENSIONS)
    return flat.reshape(len(matrix), DIMENSIONS).astype(np.int32)


def build(counts: np.ndarray, small: Callable[[int], bool], leaf: Callable[[np.ndarray], object]):
    """A tree of the rows of ``counts``; parts that are ``small`` or all alike become leaves."""

    def grow(rows: np.ndarray):
        if small(len(rows)):
            return leaf(rows)
        part = counts[rows]
        middle = np.median(part, axis=0).astype(np.int64)
        bounds = np.stack([middle, middle - 1])
        share = (part[None] <= bounds[:, None]).mean(axis=1)
        balance = np.minimum(share, 1 - share)
        side, dimension = np.unravel_index(int(balance.argmax()), balance.shape)
        if balance[side, dimension] == 0:
            apart = part.min(axis=0) < part.max(axis=0)
            if not apart.any():
                return leaf(rows)
            dimension = int(apart.argmax())
            bound = int(part[:, dimension].min())
        else:
            bound = int(bounds[side, dimension])
        left = part[:, dimension] <= bound
        return int(dimension), bound, grow(rows[left]), grow(rows[~left])

    return grow(np.arange(len(counts)))


def reach(tree, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[object, np.ndarray]]:
    """Leaves with the rows of ``counts`` that get there with at most ``up`` and ``down`` (0 or 1) changes."""
    start = np.arange(len(counts))
    stack = [(tree, start, np.full(len(start), bool(up)), np.full(len(start), bool(down)))]
    while stack:
        node, rows, ups, downs = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        dimension, bound, left, right = node
        x = counts[rows, dimension]
        inside = x <= bound
        falls = (x == bound + 1) & downs
        rises = (x == bound) & ups
        to_left, to_right = inside | falls, ~inside | rises
        stack.append((left, rows[to_left], ups[to_left], (downs & ~falls)[to_left]))
        stack.append((right, rows[to_right], (ups & ~rises)[to_right], downs[to_right]))


def _chunks(n: int, width: int) -> Iterator[slice]:
    step = max(1, AT_ONCE // max(1, width))
    return (slice(i, i + step) for i in range(0, n, step))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``a`` and ``b``, of one length, that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where ``b`` is ``a`` with one letter more."""
    length = a.shape[1]
    front = np.ones((len(a), length + 1), bool)
    back = np.ones((len(a), length + 1), bool)
    front[:, 1:] = np.logical_and.accumulate(a == b[:, :length], axis=1)
    back[:, :length] = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return (front & back).any(axis=1)


def near_pairs(points: list[str], queries: list[str], among_points: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words that are one edit apart, as places in ``points + queries``.

    Points have one length; queries have the same or one letter less.  Pairs of two points are
    given, once each, if ``among_points``; pairs of two queries never.
    """
    length = len(points[0])
    matrix = codes(points, length)
    counts = letter_counts(matrix)
    tree = build(counts, lambda n: n <= LEAF_POINTS, lambda rows: rows)
    dense = counts.astype(np.float64 if length > 2000 else np.float32)
    norms = (dense * dense).sum(axis=1)
    equal = [i for i, word in enumerate(queries) if len(word) == length]
    shorter = [i for i, word in enumerate(queries) if len(word) == length - 1]
    firsts, seconds = [], []
    for kind, chosen in (("points", None), ("equal", equal), ("shorter", shorter)):
        if kind == "points":
            if not among_points:
                continue
            asked, places = matrix, np.arange(len(points))
        elif not chosen:
            continue
        else:
            asked = codes([queries[i] for i in chosen], length - (kind == "shorter"))
            places = len(points) + np.array(chosen)
        q = counts if kind == "points" else letter_counts(asked)
        dense_q = q.astype(dense.dtype)
        norms_q = (dense_q * dense_q).sum(axis=1)
        farthest = 1 if kind == "shorter" else 2
        for leaf, rows in reach(tree, q, 1, int(kind != "shorter")):
            # Differences add up to 0 or 1, so a squared distance up to 2 or 1 is the same L1 distance.
            square = norms_q[rows, None] + norms[leaf] - 2 * (dense_q[rows] @ dense[leaf].T)
            r, c = np.nonzero(square <= farthest + 0.5)
            r, c = rows[r], leaf[c]
            if kind == "points":
                r, c = r[r < c], c[r < c]
            check = one_added if kind == "shorter" else one_replaced
            for part in _chunks(len(r), length):
                found = check(asked[r[part]], matrix[c[part]])
                firsts.append(places[r[part][found]])
                seconds.append(c[part][found])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(firsts), np.concatenate(seconds)
