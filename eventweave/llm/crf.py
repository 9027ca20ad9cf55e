"""A linear-chain conditional random field with two labels, over many short sequences at once.

Position t of a sequence adds ``x_t . w`` for label 1 (nothing for label 0); a step adds the
entry of ``step`` for its two labels. Sequences are stored one after another; ``first`` holds the
index of each one's first position, and one entry more. All sequences move on together, one
position a step, the ended ones dropping out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _order(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequences from the longest on, their first positions, sequences alive at every step)."""
    size = np.diff(first)
    long_first = np.argsort(-size, kind="stable")
    long_first = long_first[size[long_first] > 0]
    most = int(size.max(initial=0))
    alive = np.searchsorted(-size[long_first], -np.arange(most), side="left")
    return long_first, first[:-1][long_first], alive


def _add(a: np.ndarray) -> np.ndarray:
    """log sum exp over the last axis."""
    top = a.max(axis=-1)
    return top + np.log(np.exp(a - top[..., None]).sum(axis=-1))


def marginals(unary: np.ndarray, step: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of label 1 at every position, of every pair of labels at the step into every
    position, log of each sequence's sum) by the forward-backward recursions."""
    n = len(unary)
    score = np.stack([np.zeros(n), unary], axis=1)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    order, begin, alive = _order(first)
    for t, k in enumerate(alive.tolist()):
        at = begin[:k] + t
        ahead[at] = score[at] + (_add(ahead[at - 1][:, None, :] + step.T[None]) if t else 0.0)
    for t in range(len(alive) - 2, -1, -1):
        at = begin[:alive[t + 1]] + t
        back[at] = _add(step[None] + (score[at + 1] + back[at + 1])[:, None, :])
    total = np.zeros(len(first) - 1)
    last = first[1:][order] - 1
    total[order] = _add(ahead[last])
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    p = np.exp(ahead[:, 1] + back[:, 1] - total[of])
    pairs = np.zeros((n, 2, 2))
    inner = np.ones(n, bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    pairs[at] = np.exp(ahead[at - 1][:, :, None] + step[None] + (score[at] + back[at])[:, None, :] - total[of[at]][:, None, None])
    return p, pairs, total


@dataclass
class Chain:
    weight: np.ndarray          # of the features, the last one of a constant
    step: np.ndarray            # (label before, label)

    def label_chances(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(x @ self.weight[:-1] + self.weight[-1], self.step, first)[0]


def minimise(f, x: np.ndarray, rounds: int = 60, memory: int = 8, tolerance: float = 1e-6) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps; ``f`` gives value and gradient."""
    value, slope = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, held = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ way) / (s @ y)
            held.append(a)
            way -= a * y
        if pairs:
            s, y = pairs[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(held)):
            way += (a - (y @ way) / (s @ y)) * s
        if way @ slope <= 0:
            way, pairs = slope.copy(), []
        size = 1.0 if pairs else min(1.0, 1.0 / max(np.abs(slope).max(), 1e-12))
        while True:
            new = x - size * way
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * size * (way @ slope) or size < 1e-10:
                break
            size *= 0.5
        s, y = new - x, new_slope - slope
        gain = value - new_value
        if gain <= 0:
            break
        x, value, slope = new, new_value, new_slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        if gain < tolerance * max(1.0, abs(value)):
            break
    return x


def objective(theta: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray, weight: np.ndarray, ridge: float, chained: bool) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the labels (sequences weighted) plus a ridge, and its gradient."""
    k = x.shape[1] + 1
    w, step = theta[:k], theta[k:].reshape(2, 2)
    unary = x @ w[:-1] + w[-1]
    of = np.repeat(weight, np.diff(first))
    if not chained:
        p = 1 / (1 + np.exp(-np.clip(unary, -500, 500)))
        value = float((of * (np.logaddexp(0, unary) - y * unary)).sum())
        left = of * (p - y)
        slope = np.concatenate([x.T @ left, [left.sum()], np.zeros(4)])
    else:
        p, pairs, total = marginals(unary, step, first)
        inner = np.ones(len(y), bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        at = np.flatnonzero(inner)
        given = np.zeros((2, 2))
        np.add.at(given, (y[at - 1], y[at]), of[at])
        value = float((weight * total).sum() - (of * y * unary).sum() - (given * step).sum())
        left = of * (p - y)
        slope = np.concatenate([x.T @ left, [left.sum()], ((pairs * of[:, None, None]).sum(axis=0) - given).ravel()])
    held = theta.copy()
    held[k - 1] = 0.0           # the constant is free
    return value + 0.5 * ridge * float(held @ held), slope + ridge * held


def train(x: np.ndarray, y: np.ndarray, first: np.ndarray, weight: np.ndarray, *, ridge: float = 1.0, chained: bool = True) -> Chain:
    """Weights and steps of the labelled sequences."""
    k = x.shape[1] + 1
    theta = minimise(lambda t: objective(t, x, y, first, weight, ridge, chained), np.zeros(k + 4))
    return Chain(theta[:k], theta[k:].reshape(2, 2))
