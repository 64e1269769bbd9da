"""Boosted trees over a table of counts.

Features are small whole numbers, so a corpus of any size comes down to one row per distinct combination with the
number of negatives and positives. Spark counts the combinations; the fit needs nothing else, is exact over all rows and
bounded by the features. The fitted trees are a SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Two levels: the first cut, then a cut on each side; a cut is (feature, largest value on the left)."""

    root: tuple[int, int]
    sides: tuple[tuple[tuple[int, int], float, float], tuple[tuple[int, int], float, float]]

    def value(self, x: np.ndarray) -> np.ndarray:
        (lc, ll, lr), (rc, rl, rr) = self.sides
        left = np.where(x[:, lc[0]] <= lc[1], ll, lr)
        right = np.where(x[:, rc[0]] <= rc[1], rl, rr)
        return np.where(x[:, self.root[0]] <= self.root[1], left, right)

    def sql(self, names: list[str]) -> str:
        parts = [
            f"CASE WHEN {names[c[0]]} <= {c[1]} THEN {low!r} ELSE {high!r} END" for c, low, high in self.sides
        ]
        return f"CASE WHEN {names[self.root[0]]} <= {self.root[1]} THEN {parts[0]} ELSE {parts[1]} END"


def best_cut(x, cuts, grad, hess, penalty):
    """The cut with the largest gain, and the Newton steps on either side."""
    g, h = grad.sum(), hess.sum()
    best = (-np.inf, cuts[0], 0.0, 0.0)
    for f, v in cuts:
        left = x[:, f] <= v
        gl, hl = grad[left].sum(), hess[left].sum()
        gain = gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty)
        if gain > best[0]:
            best = (gain, (f, v), float(gl / (hl + penalty)), float((g - gl) / (h - hl + penalty)))
    return best


def boost(x: np.ndarray, negatives: np.ndarray, positives: np.ndarray, rounds: int = 30, rate: float = 0.3, penalty: float = 1.0) -> tuple[float, list[Tree]]:
    """Start value and trees of a logistic model of the counts."""
    total = negatives + positives
    start = float(np.log((positives.sum() + 1) / (negatives.sum() + 1)))
    cuts = [(f, int(v)) for f in range(x.shape[1]) for v in np.unique(x[:, f])[:-1]]
    margin, trees = np.full(len(x), start), []
    for _ in range(rounds if cuts else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = positives - total * p, total * p * (1 - p)
        # The first cut is the one whose best cuts on both sides gain the most.
        ranked = sorted(
            ((best_cut(x, [c], grad, hess, penalty)[0], c) for c in cuts), reverse=True
        )[:4]
        chosen = None
        for _, (f, v) in ranked:
            left = x[:, f] <= v
            sides = [best_cut(x[m], cuts, grad[m], hess[m], penalty) for m in (left, ~left)]
            gain = sides[0][0] + sides[1][0]
            if chosen is None or gain > chosen[0]:
                chosen = (gain, (f, v), sides)
        _, root, sides = chosen
        tree = Tree(root, tuple((s[1], rate * s[2], rate * s[3]) for s in sides))
        trees.append(tree)
        margin = margin + tree.value(x)
    return start, trees


def margins(start: float, trees: list[Tree], x: np.ndarray) -> np.ndarray:
    return start + sum((t.value(x) for t in trees), np.zeros(len(x)))


def margin_sql(start: float, trees: list[Tree], names: list[str]) -> str:
    return " + ".join([repr(start), *(t.sql(names) for t in trees)])


def precise_margin(margin: np.ndarray, negatives: np.ndarray, positives: np.ndarray, precision: float) -> float:
    """The lowest margin from which on every calibrated share of positives is high enough; infinite if there is none.

    Shares are isotonic in the margin (pooled adjacent violators), and one negative is added to each pool, so
    a pool of a few counts is not trusted.
    """
    levels, index = np.unique(margin, return_inverse=True)
    pools: list[list[float]] = []
    for low, no, yes in zip(levels, np.bincount(index, negatives), np.bincount(index, positives)):
        pools.append([low, no, yes])
        while len(pools) > 1 and pools[-2][2] * (pools[-1][1] + pools[-1][2]) >= pools[-1][2] * (pools[-2][1] + pools[-2][2]):
            _, no, yes = pools.pop()
            pools[-1][1] += no
            pools[-1][2] += yes
    cut = float("inf")
    for low, no, yes in reversed(pools):
        if yes < precision * (no + yes + 1):
            break
        cut = float(low)
    return cut
