"""Word hashes of batches of texts, with numpy (inside tasks)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def split(text: str | None) -> list[bytes]:
    """Words: runs without space, tab, line feed, vertical tab, form feed, carriage return. Splitting
    bytes at ASCII white space is exactly that."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashed(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words end to end, where each text's words begin, with the end last)."""
    ends = np.cumsum([0, *map(len, texts)])
    flat = np.empty(int(ends[-1]), dtype=object)
    flat[:] = [w for words in texts for w in words]
    codes, distinct = pd.factorize(flat)
    if not len(distinct):
        return np.zeros(0, np.uint64), ends
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[codes], ends


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that begin at each place (short by k - 1 places); by doubling, so the
    work goes with the logarithm of ``k``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # power[i]: hashes of 2**i words; a run of k words is put together from the binary digits of k.
    out, at, step, size, factor = None, 0, h, 1, FACTOR
    while True:
        if k & size:
            piece = step[at:at + n]
            out = piece.copy() if out is None else out * factor + piece
            at += size
        if size * 2 > k:
            return mixed(out)
        step = step[:-size] * factor + step[size:]
        factor = np.uint64(int(factor) ** 2 % 2 ** 64)
        size *= 2
