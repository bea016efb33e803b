"""A hashed linear scorer (logistic), fitted on a bounded sample: shared by
the quality and the toxicity operators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash

from keelson.llm.common import sigmoid

BUCKETS = 1 << 20


def bucket(name: str | bytes) -> int:
    return xxhash.xxh3_64_intdigest(name) & (BUCKETS - 1)


@dataclass
class Scorer:
    """log-odds = bias + the weights of the distinct features that occur."""

    bias: float = -20.0
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, features: set[int]) -> float:
        return sigmoid(self.bias + sum(self.weights.get(f, 0.0) for f in sorted(features)))


def telling(rows: list[np.ndarray], y: np.ndarray, always: np.ndarray, least: int = 3, z: float = 3.5) -> np.ndarray:
    """Features whose rate differs between the classes by ``z`` deviations,
    and those of ``always`` that occur."""
    used, n = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_counts=True)
    n1 = np.zeros(len(used))
    for r, mass in zip(rows, y.tolist()):  # a row's features are distinct
        n1[np.searchsorted(used, r)] += mass
    rate = y.mean() if len(y) else 0.0
    apart = (n1 - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9))
    return used[(n >= least) & (np.abs(apart) >= z) | np.isin(used, always)]


def fit(rows: list[np.ndarray], y: np.ndarray, swapped: list[tuple[int, np.ndarray]] = (), penalty: float = 1.0,
        l2: float = 1e-4, rounds: int = 400, rate: float = 0.1) -> Scorer:
    """Adam on the mean log loss of (soft) labels ``y``. ``swapped`` holds
    (row, features of that row with identity terms swapped): the squared change
    of the log-odds between the two is penalised."""
    if not len(y):
        return Scorer()
    if y.min() == y.max():
        return Scorer(bias=float(np.log((y[0] + 1e-6) / (1 - y[0] + 1e-6))))
    always = np.unique(np.concatenate([np.setxor1d(rows[i], f) for i, f in swapped])) if len(swapped) else np.zeros(0, np.int64)
    used = telling(rows, y, always)

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keep = [np.flatnonzero(np.isin(r, used)) for r in sets]
        col = np.concatenate([np.searchsorted(used, r[k]) for r, k in zip(sets, keep)] or [np.zeros(0, np.int64)])
        return np.repeat(np.arange(len(sets)), [len(k) for k in keep]), col

    row, col = flat(rows)
    a_row, a_col = flat([rows[i] for i, _ in swapped])
    b_row, b_col = flat([f for _, f in swapped])
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    for step in range(1, rounds + 1):
        odds = w[-1] + np.bincount(row, w[col], len(y))
        miss = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(col, miss[row], len(used)), miss.sum())
        if len(swapped):
            change = 2 * penalty / len(swapped) * (np.bincount(a_row, w[a_col], len(swapped)) - np.bincount(b_row, w[b_col], len(swapped)))
            g[:-1] += np.bincount(a_col, change[a_row], len(used)) - np.bincount(b_col, change[b_row], len(used))
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Scorer(float(w[-1]), {int(f): float(x) for f, x in zip(used, w) if abs(x) > 1e-6})


class Cache(dict):
    """token -> features (or None), kept for at most ``size`` tokens."""

    def __init__(self, compute, size: int = 400_000):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, token):
        if len(self) >= self.size:
            self.clear()
        found = self[token] = self.compute(token)
        return found

    def union(self, tokens: Iterator) -> set[int]:
        return set().union(*filter(None, map(self.__getitem__, tokens)))
