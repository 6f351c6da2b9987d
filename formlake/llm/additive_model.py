"""A generalised additive model with pairwise interactions, by cyclic boosting.

Features are cut into bins at quantiles. Round after round, each feature in turn gets a
shallow tree on the gradient of the log loss, added with a small step to its lookup table
over bins. The pairs that explain most of what is left then get tables over two features'
bins in the same way. A score is the sum of the looked-up values.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

BINS, PAIR_BINS = 32, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 6
RATE, SHRINK = 0.1, 1.0
LEAF_ROWS = 3


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _best_cut(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Improvement and place of the best cut of bins with these gradient sums."""
    left_g, left_h, left_n = np.cumsum(gain)[:-1], np.cumsum(weight)[:-1], np.cumsum(rows)[:-1]
    all_g, all_h, all_n = gain.sum(), weight.sum(), rows.sum()
    if not len(left_g):
        return 0.0, -1
    better = left_g**2 / (left_h + SHRINK) + (all_g - left_g) ** 2 / (all_h - left_h + SHRINK) - all_g**2 / (all_h + SHRINK)
    better = np.where((left_n >= LEAF_ROWS) & (all_n - left_n >= LEAF_ROWS), better, -1.0)
    best = int(np.argmax(better))
    return (float(better[best]), best) if better[best] > 0 else (0.0, -1)


def _leaf(gain: np.ndarray, weight: np.ndarray) -> float:
    return float(gain.sum() / (weight.sum() + SHRINK))


def _line_tree(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over the bins of one feature, as a table."""
    spans = [(0, len(gain))]
    for _ in range(2):
        found = [(*_best_cut(gain[a:b], weight[a:b], rows[a:b]), a, b) for a, b in spans]
        better, cut, a, b = max(found)
        if cut < 0:
            break
        spans.remove((a, b))
        spans += [(a, a + cut + 1), (a + cut + 1, b)]
    table = np.zeros(len(gain))
    for a, b in spans:
        table[a:b] = _leaf(gain[a:b], weight[a:b])
    return table


def _plane_tree(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """Improvement, and a tree of depth two over the bins of two features as a table."""
    best = (0.0, np.zeros_like(gain))
    for axis in (0, 1):
        g, h, n = (x if axis == 0 else x.T for x in (gain, weight, rows))
        first, cut = _best_cut(g.sum(axis=1), h.sum(axis=1), n.sum(axis=1))
        if cut < 0:
            continue
        table, total = np.zeros_like(g), first
        for side in (slice(0, cut + 1), slice(cut + 1, len(g))):
            better, second = _best_cut(g[side].sum(axis=0), h[side].sum(axis=0), n[side].sum(axis=0))
            total += better
            for part in (slice(0, second + 1), slice(second + 1, g.shape[1])):
                table[side, part] = _leaf(g[side, part], h[side, part])
        if total > best[0]:
            best = (total, table if axis == 0 else table.T)
    return best


@dataclass
class AdditiveModel:
    """Lookup tables; their size depends on the features alone."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, one for each row."""
        margin = np.full(len(features), self.intercept)
        for column, cuts, table in zip(features.T, self.cuts, self.tables):
            margin += table[np.searchsorted(cuts, column, side="right")]
        for a, b, table in self.pairs:
            at = [np.searchsorted(self.pair_cuts[i], features[:, i], side="right") for i in (a, b)]
            margin += table[at[0], at[1]]
        return _logistic(margin)


def fit(features: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Fit to rows of features and labels, 0 and 1 both among them."""
    share = labels.mean()
    model = AdditiveModel(float(np.log(share / (1 - share))))
    width = features.shape[1]
    model.cuts = [_cuts(features[:, i], BINS) for i in range(width)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, features[:, i], side="right") for i, c in enumerate(model.cuts)]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    margin = np.full(len(labels), model.intercept)
    for _ in range(ROUNDS):
        for b, n, table in zip(bins, counts, model.tables):
            p = _logistic(margin)
            gain = np.bincount(b, labels - p, minlength=len(table))
            step = RATE * _line_tree(gain, np.bincount(b, p * (1 - p), minlength=len(table)), n)
            table += step
            margin += step[b]
    model.pair_cuts = [_cuts(features[:, i], PAIR_BINS) for i in range(width)]
    coarse = [np.searchsorted(c, features[:, i], side="right") for i, c in enumerate(model.pair_cuts)]

    def plane(a: int, b: int) -> tuple[float, np.ndarray, np.ndarray]:
        shape = (len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1)
        cell, p = coarse[a] * shape[1] + coarse[b], _logistic(margin)
        size = shape[0] * shape[1]
        sums = [np.bincount(cell, w, minlength=size).reshape(shape) for w in (labels - p, p * (1 - p), np.ones(len(p)))]
        return *_plane_tree(*sums), cell

    ranked = sorted(((plane(a, b)[0], a, b) for a, b in combinations(range(width), 2)), reverse=True)
    chosen = [(a, b) for better, a, b in ranked[:PAIRS] if better > 0]
    pair_tables = {pair: 0.0 for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for pair in chosen:
            _, tree, cell = plane(*pair)
            pair_tables[pair] = pair_tables[pair] + RATE * tree
            margin += RATE * tree.reshape(-1)[cell]
    model.pairs = [(a, b, pair_tables[a, b]) for a, b in chosen]
    return model
