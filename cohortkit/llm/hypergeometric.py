"""Exact hypergeometric draws for small tables of counts (driver side; the tables' sizes are bounded)."""

from __future__ import annotations

import math

import numpy as np

NUMPY_LIMIT = 10 ** 9  # numpy's own sampler takes populations below this


def draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    # Inversion over the values that carry all but 1e-30 of the mass: the log weights relative to the
    # mode are sums of logs of the ratios of neighbouring weights, and need no factorials.
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    width = 12 * math.sqrt(n * (good / total) * (bad / total) * max(total - n, 1) / max(total - 1, 1)) + 50
    a, b = max(low, int(mode - width)), min(high, int(mode + width))
    x = np.arange(a, b, dtype=np.float64)
    steps = np.log((good - x) * (n - x)) - np.log((x + 1) * (bad - n + x + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def draw_many(rng: np.random.Generator, counts: list[int], n: int) -> list[int]:
    """A multivariate draw: how many of ``n`` draws fall to each of ``counts``."""
    rest, out = sum(counts), []
    for c in counts:
        rest -= c
        got = draw(rng, c, rest, n)
        out.append(got)
        n -= got
    return out


def split_tree(rng: np.random.Generator, quotas: list[int], slots: list[int]) -> list[list[int]]:
    """``quotas`` (by source) dealt exactly to shards with ``slots`` places each: a tree that halves the
    shards and draws, at every node, which part of each quota goes left."""
    if len(slots) == 1:
        return [quotas]
    half = len(slots) // 2
    left = draw_many(rng, quotas, sum(slots[:half]))
    right = [q - x for q, x in zip(quotas, left, strict=True)]
    return split_tree(rng, left, slots[:half]) + split_tree(rng, right, slots[half:])
