"""Hashed word and character n-gram features and small numpy linear models over them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np

HASH_BITS = 18
CACHE_WORDS = 400_000  # distinct words remembered per Python worker before the cache restarts


WORD_SEED, GRAM_SEED = zlib.crc32(b"w"), zlib.crc32(b"c")


def word_features(word: bytes, sizes: tuple[int, ...], bits: int = HASH_BITS) -> list[int]:
    """Hashes of the word and of its character n-grams (word ends marked)."""
    mask, crc = (1 << bits) - 1, zlib.crc32
    out = [crc(word, WORD_SEED) & mask]
    if word.isascii():
        marked = b"\x02" + word + b"\x03"
        for n in sizes:
            out += [crc(marked[i:i + n], GRAM_SEED) & mask for i in range(len(marked) - n + 1)]
    else:  # n-grams of characters, not of bytes
        text = f"\x02{word.decode('utf-8', 'replace')}\x03"
        for n in sizes:
            out += [crc(text[i:i + n].encode(), GRAM_SEED) & mask for i in range(len(text) - n + 1)]
    return out


class WordCache:
    """Remembers ``make(word)`` for the words met last; bounded, so any vocabulary fits."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        self.make, self.limit, self.known = make, limit, {}

    def many(self, words: Iterable[bytes]) -> list:
        known, make = self.known, self.make
        if len(known) > self.limit:
            known.clear()
        out = []
        for w in words:
            value = known.get(w)
            if value is None:
                value = known[w] = make(w)
            out.append(value)
        return out


class WordIndex:
    """Numbers words as they come, with one value per word; bounded like the cache, so numbers
    hold within a text, not across texts."""

    def __init__(self, make: Callable[[bytes], float], limit: int = CACHE_WORDS):
        self.make, self.limit = make, limit
        self.ids: dict[bytes, int] = {}
        self.values = np.zeros(1024)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        if len(ids) > self.limit:
            ids.clear()
        get = ids.get
        codes = np.array([get(w, -1) for w in words], dtype=np.int64)
        for i in np.flatnonzero(codes < 0).tolist():
            word = words[i]
            number = ids.setdefault(word, len(ids))
            if number == len(ids) - 1:  # new, or met again at once: the value is the same
                if number >= len(self.values):
                    self.values = np.concatenate([self.values, np.zeros(len(self.values))])
                self.values[number] = self.make(word)
            codes[i] = number
        return codes


class SparseRows:
    """Rows of a sparse matrix, with the two products that gradient descent needs."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], dim: int):
        self.n, self.dim = len(rows), dim
        sizes = np.array([len(i) for i, _ in rows], dtype=np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.col = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.val = np.concatenate([v for _, v in rows] or [np.zeros(0)]).astype(np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.val * w[self.col], minlength=self.n)

    def back(self, err: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=self.val * err[self.row], minlength=self.dim)


def sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    def __init__(self, dim: int, rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = np.zeros(dim), np.zeros(dim)

    def step(self, w: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad * grad
        m, v = self.m / (1 - 0.9 ** self.t), self.v / (1 - 0.999 ** self.t)
        return w - self.rate * m / (np.sqrt(v) + 1e-8)


def fit_logistic(x: SparseRows, y: np.ndarray, weight: np.ndarray, l2: float, steps: int,
                 rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weighted L2 logistic regression, full-batch Adam; returns ``(weights, bias)``."""
    w, adam = np.zeros(x.dim + 1), Adam(x.dim + 1, rate)
    weight = weight / weight.sum()
    for _ in range(steps):
        err = weight * (sigmoid(x.dot(w[:-1]) + w[-1]) - y)
        w = adam.step(w, np.r_[x.back(err) + l2 * w[:-1], err.sum()])
    return w[:-1], float(w[-1])


def fit_platt(raw: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Platt scaling with smoothed targets: ``p = sigmoid(a * raw + b)``, by Newton's method."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = float(np.abs(raw).max()) or 1.0
    z = np.stack([raw / scale, np.ones(len(raw))], axis=1)
    ab = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(z @ ab)
        grad = z.T @ (p - target)
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab = ab - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0] / scale), float(ab[1])
