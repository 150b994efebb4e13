"""Hashes of many byte strings at once, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_SEED = np.random.default_rng(20_240_229)
_CODES = _SEED.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Polynomial hashes (modulo 2 to the 64th, over random codes of the bytes) of any substrings of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * _powers(_BASE, n + 1)[:n], out=self.prefix[1:])
        self.unscale = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.unscale[start])

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of the width; none if the buffer is shorter."""
        n = len(self.prefix) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        return mixed((self.prefix[width:] - self.prefix[:-width]) * self.unscale[: n + 1 - width])


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[range]:
    """Ranges of neighbouring texts of about ``limit`` bytes in total, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield range(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))
