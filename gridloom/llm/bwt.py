"""Equal windows of a collection of strings, by merging Burrows-Wheeler transforms of shards.

The strings of one sending task lie in one shard. Each shard sorts its own suffixes and writes its
transform: the symbol before each suffix, in suffix order. The shards' transforms are then merged without sorting
suffixes again: an interleave says which shard each merged row comes from, and one pass over it,
which deals the rows out stably by their symbols, makes an interleave that is right for suffixes
of depth h into one that is right for depth h + 1. Rows whose suffixes agree up to the present
depth form blocks; where a block falls apart at depth h, the neighbours have h - 1 symbols in
common: so the common prefixes of all neighbours come out of the passes, and from them the intervals
of windows that repeat, without looking at any text.

A symbol is a run of neighbouring bytes (ten for windows of 50) and the suffix after it starts as
many bytes on, so that a window takes few passes; every byte starts a suffix all the same. Each
string ends in a symbol of its own kind, smaller than all others.
"""

import numpy as np

#: Shards that are merged at once; tasks whose numbers leave the same rest share one.
SHARDS = 4


def ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of non-negative integers, and the integers in that order.

    Where key and place fit 64 bits together, one sort of plain numbers does it.
    """
    if not len(key):
        return np.zeros(0, np.int64), key
    bits = (len(key) - 1).bit_length()
    if bits + int(key.max()).bit_length() <= 64:
        both = (key.astype(np.uint64) << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64)
        both.sort()
        return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
    order = np.argsort(key, kind="stable")
    return order, key[order]


def ranked(key: np.ndarray) -> np.ndarray:
    """Each value's place among the distinct values."""
    order, s = ordered(key)
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(False, s[1:] != s[:-1]))[: len(s)]
    return out


def suffix_order(symbol: np.ndarray, left: np.ndarray, step: int, depth: int) -> np.ndarray:
    """Rows in the order of their first depth symbols; left counts a row's symbols before its end."""
    rank, have = symbol.astype(np.int64), 1
    order = ordered(rank)[0]
    while have < depth:
        # the next symbols to look at: as many again, or those that are still wanted
        more = min(have, depth - have)
        ahead = np.zeros(len(symbol), np.int64)
        # rows that end before have no symbols there; nothing reaches beyond a string's end
        on = np.flatnonzero(left >= more)
        ahead[on] = rank[on + more * step]
        order, s = ordered(rank * (int(rank.max(initial=0)) + 1) + ahead)
        rank[order] = np.cumsum(np.append(False, s[1:] != s[:-1]))[: len(s)]
        have += more
    return order


def transform(symbol: np.ndarray, order: np.ndarray, starts: np.ndarray, step: int) -> np.ndarray:
    """The symbol before each row, in suffix order; 0 before a string's first rows."""
    before = np.zeros(len(symbol), symbol.dtype)
    before[step:] = symbol[:-step]
    before[starts] = 0
    return before[order]


def merge(columns: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards (a shard number for each merged row), and the symbols that each row's
    suffix has in common with the one before it, up to depth (below 256)."""
    all_ = np.concatenate(columns)
    source = np.repeat(np.arange(len(columns), dtype=np.uint8), [len(c) for c in columns])
    block = np.zeros(len(all_), np.int32)
    symbol = np.empty_like(all_)
    common = np.full(len(all_), depth, np.uint8)
    common[:1] = 0
    for have in range(depth):
        # the rows of a shard lie in its own order: they take its transform's symbols one by one
        symbol[np.argsort(source, kind="stable")] = all_
        dealt, now = ordered(symbol)
        source, block = source[dealt], block[dealt]
        edge = (now[1:] != now[:-1]) | (block[1:] != block[:-1])
        # places only fall apart further: where they do for the first time now, the suffixes share what
        # was seen before
        np.minimum(common[1:], np.where(edge, np.uint8(have), np.uint8(255)), out=common[1:])
        np.cumsum(edge, out=block[1:])
        block[:1] = 0
    return source, common


def intervals(common: np.ndarray, depth: int) -> np.ndarray:
    """The number of each row's interval: a longest run of rows with depth symbols in common."""
    return np.cumsum(common < depth, dtype=np.int32)


def _alphabet(data: np.ndarray, n: int, step: int) -> np.ndarray:
    """For each of the first n rows, the number of the step bytes that start there, from 1."""
    if step == 10:
        five = _alphabet(data, n + 5, 5)
        return ranked(five[:n] * (int(five.max(initial=0)) + 1) + five[5:]) + 1
    key = np.zeros(n, np.int64)
    for k in range(step):
        key = (key << 8) | data[k : k + n]
    return ranked(key) + 1


class Merged:
    """Strings dealt into shards, the shards' own suffix orders and transforms, and their merge."""

    def __init__(self, strings: list[bytes], width: int, shards: int = SHARDS, shard: np.ndarray | None = None):
        self.step = step = max(s for s in (1, 2, 3, 4, 5, 10) if width % s == 0)
        self.depth = width // step
        shard = np.arange(len(strings)) % shards if shard is None else np.asarray(shard) % shards
        #: strings lie by shard
        self.at = np.argsort(shard, kind="stable")
        strings = [strings[k] for k in self.at]
        sizes = np.array([len(s) + step for s in strings], np.int64)
        self.firsts = firsts = np.cumsum(sizes) - sizes
        data = np.frombuffer((b"\0" * step).join(strings) + b"\0" * (3 * step), np.uint8)
        self.n = n = int(sizes.sum())
        # symbols from a row to its string's end; the last step rows of a string are its end
        left = (np.repeat(firsts + sizes - step, sizes) - np.arange(n) + step - 1) // step
        symbol = np.where(left <= 0, 0, _alphabet(data, n, step)).astype(np.int32)
        left = np.maximum(left, 0)
        bounds = np.searchsorted(shard[self.at], np.arange(shards + 1))
        self.orders, columns = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a < b:
                x, y = int(firsts[a]), int(firsts[b - 1] + sizes[b - 1])
                order = suffix_order(symbol[x:y], left[x:y], step, self.depth)
                self.orders.append(x + order)
                columns.append(transform(symbol[x:y], order, (firsts[a:b, None] - x + np.arange(step)).reshape(-1), step))
        self.source, self.common = merge(columns, self.depth) if columns else (np.zeros(0, np.uint8), np.zeros(0, np.uint8))

    def rows(self) -> np.ndarray:
        """The text position of each merged row: shards give theirs in order."""
        out = np.empty(self.n, np.int64)
        out[np.argsort(self.source, kind="stable")] = np.concatenate(self.orders) if self.orders else out
        return out


def window_classes(strings: list[bytes], width: int, shards: int = SHARDS, shard: np.ndarray | None = None) -> list[np.ndarray]:
    """For each string, a class number for each of its windows of width bytes.

    Two windows have the same class exactly if they are equal: they lie in one interval of the merged
    transform. Strings shorter than width have none. shard, taken modulo shards, tells which strings
    were sent together.
    """
    m = Merged(strings, width, shards, shard)
    out = np.zeros(m.n, np.int32)
    out[m.rows()] = intervals(m.common, m.depth)
    found: list = [None] * len(strings)
    for k, f in zip(m.at.tolist(), m.firsts.tolist(), strict=True):
        found[k] = out[f : f + max(0, len(strings[k]) - width + 1)]
    return found
