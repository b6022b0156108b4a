"""Cutting-stock linear program over a length histogram, by column generation.

The master problem chooses how many sequences to cut by each pattern so that
every length is covered; a pattern is a multiset of lengths with a sum of at
most ``capacity``. Prices of new columns come from an unbounded knapsack over
the dual values. The input is a histogram of at most ``capacity`` lengths, so
this work has a fixed size whatever the number of documents.
"""

from __future__ import annotations

import numpy as np


def knapsack(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of lengths with a sum of at most ``capacity``: its value and its counts."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1, np.int64)
    for c in range(1, capacity + 1):
        m = int(np.searchsorted(lengths, c, side="right"))
        best[c] = best[c - 1]
        if m:
            v = best[c - lengths[:m]] + value[:m]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], pick[c] = v[i], i
    counts = np.zeros(len(lengths), np.int64)
    c = capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= int(lengths[pick[c]])
    return float(best[capacity]), counts


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.002,
          rounds: int = 1500) -> list[tuple[np.ndarray, float]]:
    """Basic patterns and how often to use each, from a revised simplex method.

    Stops when the objective is within ``gap`` of a proven lower bound (the
    larger of the volume bound and Farley's bound from the prices), or after
    ``rounds`` columns. Both only end the search early: uses are rounded to whole
    numbers against the true demand later, so rounding errors cannot lose a row.
    """
    m = len(lengths)
    if not m:
        return []
    d = demand.astype(float)
    per = capacity // lengths
    basis = np.diag(per).astype(np.int64)  # column j: as many copies of length j as fit
    inverse = np.diag(1.0 / per)
    x = d / per
    bound = float((d * lengths).sum()) / capacity
    for _ in range(rounds):
        prices = inverse.sum(axis=0)  # every pattern costs one sequence
        total = float(x.sum())
        if total <= bound * (1 + gap):
            break
        value, counts = knapsack(prices, lengths, capacity)
        if value <= 1 + 1e-9:
            break
        bound = max(bound, total / value)
        step = inverse @ counts
        ok = step > 1e-9
        ratio = np.where(ok, x / np.where(ok, step, 1), np.inf)
        out = int(ratio.argmin())
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out] = counts
    return [(basis[:, j], float(x[j])) for j in range(m) if x[j] > 1e-9]


def whole_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, **options) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole numbers of uses that cover every demand exactly.

    Uses are rounded down; what is left (less than one use of each basic
    pattern) is packed by best-fit decreasing.
    """
    left = demand.astype(np.int64).copy()
    out: list[tuple[np.ndarray, int]] = []
    for counts, uses in sorted(solve(lengths, demand, capacity, **options), key=lambda p: -p[1]):
        n = int(uses + 1e-6)
        held = counts > 0
        n = min(n, int((left[held] // counts[held]).min()))
        if n > 0:
            out.append((counts, n))
            left -= n * counts
    room = np.empty(0, np.int64)
    bins: list[np.ndarray] = []
    for i in range(len(lengths) - 1, -1, -1):
        for _ in range(int(left[i])):
            fits = np.flatnonzero(room >= lengths[i])
            if len(fits):
                j = int(fits[room[fits].argmin()])
            else:
                j = len(bins)
                bins.append(np.zeros(len(lengths), np.int64))
                room = np.append(room, capacity)
            bins[j][i] += 1
            room[j] -= lengths[i]
    return out + [(b, 1) for b in bins]
