"""Words of texts and rolling hashes of their sequences, for whole batches of texts in numpy."""

import numpy as np

from gridloom.llm.blocks import mix

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
#: A 64-bit value for each byte: a fixed function of it.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k below n."""
    if len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The words of some texts laid out one after another.

    doc: index of each word's text; start, end: its bytes in data; hash: 64 bits of them.
    """

    def __init__(self, texts: list, lower: bool = False):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(parts)
        if lower:
            self.data = self.data.translate(_LOWER)
        b = np.frombuffer(self.data, np.uint8)
        inside = np.append(~_SPACE[b], False)
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
        self.start, self.end = edge[0::2], edge[1::2]
        sizes = np.array([len(x) + 1 for x in parts], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.doc = np.searchsorted(self.first, self.start, side="right") - 1
        up, down = powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every k consecutive words of one text, and the index of their first words."""
        return grams(self.hash, self.doc, k)


def grams(x: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(x) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(_BASE) + x[j : j + n]
    return mix(h[at]), at
