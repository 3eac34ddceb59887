"""Hashed character n-grams of many texts at once, and logistic regression over sparse rows."""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint32(0x9E3779B1)
CHUNK = 1 << 20  # characters that are hashed at once


def code_points(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased unless told otherwise, in one array, and where each text ends in it."""
    cased = (t.lower() if lower and t else t or "" for t in texts)
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in cased]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32), np.cumsum([len(p) for p in parts], dtype=np.int64)


def hashed(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place but the last order - 1."""
    n = max(0, len(points) - order + 1)
    h = np.full(n, order, np.uint32)
    for k in range(order):
        h *= MULTIPLIER
        h ^= points[k : k + n]
        h ^= h >> np.uint32(15)
    return (h * MULTIPLIER) >> np.uint32(32 - bits)


def occurrences(points: np.ndarray, ends: np.ndarray, orders: tuple[int, ...], bits: int, wanted: np.ndarray | None = None):
    """(text, bucket) arrays of n-grams that lie within one text, in parts of bounded size; only `wanted` buckets."""
    for order in orders:
        for at in range(0, len(points), CHUNK):
            buckets = hashed(points[at : at + CHUNK + order - 1], order, bits)
            start = np.flatnonzero(wanted[buckets]) if wanted is not None else np.arange(len(buckets))
            text = np.searchsorted(ends, start + at, side="right")
            inside = start + at + order <= ends[text] if len(start) else np.empty(0, bool)
            yield text[inside], buckets[start[inside]]


def present(points, ends, orders, bits, wanted=None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs, each once, sorted."""
    found = [np.unique(t.astype(np.int64) << bits | b) for t, b in occurrences(points, ends, orders, bits, wanted)]
    pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, width: int, penalty: float, rounds: int = 150, step: float = 0.1):
    """(weights, bias) of a logistic fit to targets in [0, 1] over sparse (row, column, value) entries.

    Full-batch gradient steps with per-weight scaling (Adam), the same for the same input.
    """
    base = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
    w, b = np.zeros(width), float(np.log(base / (1 - base)))
    if not len(value):
        return w, b
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, rounds + 1):
        error = sigmoid(np.bincount(row, value * w[column], len(y)) + b) - y
        g = np.bincount(column, value * error[row], width) / len(y) + penalty * w
        gb = error.mean()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        down, up = 1 - 0.9**t, 1 - 0.99**t
        rate = step * (1 - t / (rounds + 1))
        w -= rate * (m / down) / (np.sqrt(v / up) + 1e-10)
        b -= rate * (mb / down) / (np.sqrt(vb / up) + 1e-10)
    return w, b
