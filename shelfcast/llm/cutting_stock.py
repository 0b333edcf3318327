"""Cutting stock by column generation over a histogram of lengths (numpy; size set by the class count).

The linear program picks how often each pattern (a multiset of classes that fits
the capacity) is used so that every class's count is met, with as few sequences
as possible. Patterns are generated on demand: an unbounded knapsack, solved by
dynamic programming over the capacity, prices the best new pattern with the
current duals. Rounded down, the basis leaves a few pieces for each pattern;
first-fit decreasing places them.
"""

from __future__ import annotations

import warnings

import numpy as np

#: Stop when the lower bound LP / (best reduced pattern value) is this close to the LP.
GAP = 1e-3
MAX_COLUMNS = 6000


def price(duals: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best unbounded knapsack: its value and the count of each class."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    order = np.argsort(-duals / widths, kind="stable")
    order = order[duals[order] > 1e-12]
    for room in range(1, capacity + 1):
        fits = order[widths[order] <= room]
        best[room], took[room] = best[room - 1], -1
        if len(fits):
            value = best[room - widths[fits]] + duals[fits]
            k = int(np.argmax(value))
            if value[k] > best[room] + 1e-15:
                best[room], took[room] = value[k], fits[k]
    counts = np.zeros(len(widths))
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            counts[took[room]] += 1
            room -= widths[took[room]]
    return float(best[capacity]), counts


def solve(widths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns [(count of each class, times used)] that meet ``demand`` exactly.

    If ``MAX_COLUMNS`` patterns do not bring the LP within ``GAP`` of its bound, a
    warning says so: the patterns still meet the demand, with more padding.
    """
    m = len(widths)
    if not m:
        return []
    per = capacity // widths
    basis = np.diag(per.astype(np.int64))                    # column j: a sequence filled with class j
    inverse = np.diag(1.0 / per)
    used = demand / per
    for _ in range(MAX_COLUMNS):
        duals = inverse.sum(axis=0)                          # every column costs one sequence
        value, column = price(duals, widths, capacity)
        if value <= 1 + GAP:                                 # LP / value bounds the optimum from below
            break
        direction = (inverse * column).sum(axis=1)
        ratio = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        move = ratio[leave]
        used = np.maximum(used - move * direction, 0)
        used[leave] = move
        basis[:, leave] = column
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
    else:
        warnings.warn(f"pricing ended after {MAX_COLUMNS} patterns, before the bound was met")
    left = demand.astype(np.int64).copy()
    patterns = []
    for j in range(m):
        column = basis[:, j]
        times = int(min(np.floor(used[j] + 1e-7), np.min(left[column > 0] // column[column > 0])))
        if times > 0:
            patterns.append((column, times))
            left -= column * times
    return patterns + first_fit(widths, left, capacity)


def first_fit(widths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Fill sequences with the largest class that still fits, until ``left`` is used up."""
    order = np.argsort(-widths, kind="stable")
    left, patterns = left.copy(), []
    while left.any():
        column, room = np.zeros(len(widths), np.int64), capacity
        for j in order:
            take = min(int(left[j]), room // int(widths[j]))
            column[j] += take
            room -= take * int(widths[j])
        times = int(np.min(left[column > 0] // column[column > 0]))
        patterns.append((column, times))
        left -= column * times
    return patterns
