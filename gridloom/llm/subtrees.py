"""Equal windows and maximal repeats of a collection of word sequences, by prefix-partitioned suffix trees.

Suffixes are counted by their first words; a prefix that more suffixes have than fit in memory at
once is made a word longer, and so on, so that prefixes have different lengths and every group of
them is small. Each group's suffixes are then sorted into a subtree: their order, and how many words
neighbours in it have in common, from which its internal nodes follow. A node as deep as a window
stands for words that repeat: the topmost such nodes are the classes of equal windows, and those
whose occurrences are preceded by different words are the maximal repeats.

Sequences that are equal to an earlier one, and windows that nothing can be equal to, are no
concern of this module: see repeats.
"""

from array import array
from collections.abc import Iterator

import numpy as np

#: Suffixes of a group: few enough that its subtree is built within a processor's cache.
LIMIT = 1 << 10


def numbered(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words (separated by one space) of all strings as numbers from 1, and each string's word count."""
    known: dict[bytes, int] = {}
    out, sizes = array("i"), array("q")
    for s in strings:
        words = s.split(b" ") if s else []
        sizes.append(len(words))
        out.extend([known.setdefault(w, len(known) + 1) for w in words])
    return np.frombuffer(out, np.int32) if out else np.zeros(0, np.int32), np.array(sizes, np.int64)


def _by(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order, and the number of each place's run of equal keys."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    return order, np.cumsum(np.append(False, s[1:] != s[:-1]))[: len(s)]


def prefix_groups(words: np.ndarray, starts: np.ndarray, depth: int, limit: int = LIMIT) -> Iterator[np.ndarray]:
    """Groups of places in starts, by prefixes of so many words that a group has about limit suffixes.

    Every start has depth words at least. A prefix of one suffix only is in no group; one of depth
    words is not made longer, however many have it.
    """
    todo = [(np.arange(len(starts)), 0)]
    while todo:
        at, level = todo.pop()
        if len(at) <= limit or level == depth:
            if len(at) > 1:
                yield at
            continue
        order, label = _by(words[starts[at] + level])
        at, counts = at[order], np.bincount(label)
        ends, first, size = np.cumsum(counts), 0, 0
        # prefixes that lie together share a group; one that is too large by itself is lengthened
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
            if size and size + n > limit:
                todo.append((at[first : end - n], depth))
                first, size = end - n, 0
            if n > limit:
                todo.append((at[first:end], level + 1))
                first = end
            else:
                size += n
        if size:
            todo.append((at[first:], depth))


def subtree(words: np.ndarray, starts: np.ndarray, room: np.ndarray, least: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Order of a group's suffixes and the words that each has in common with the one before it.

    room is the number of words a suffix has. Suffixes that share fewer than least words with every
    other are leaves that hang too high, and are left out; common words below least count as 0.
    Unless whole, suffixes are told apart up to least words only.
    """
    at, label = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    size, level = int(words.max(initial=0)) + 1, 0
    while len(at) and level < least:
        order, label = _by(label * size + words[starts[at] + level])
        inner = np.bincount(label)[label] > 1
        at, label, level = at[order][inner], label[inner], level + 1
    # places stay where they are from now on: runs of equal labels only fall apart
    common = np.where(np.append(True, label[1:] != label[:-1])[: len(label)], 0, -1)
    while whole and len(at):
        ended = room[at] <= level
        if not ((common < 0) & ~ended).any():
            break
        follow = np.where(ended, 0, words[np.minimum(starts[at] + level, len(words) - 1)])
        order, label = _by(label * size + follow)
        at = at[order]
        common[np.append(False, label[1:] != label[:-1]) & (common < 0)] = level
        level += 1
    return at, np.where(common < 0, room[at] if whole else least, common)


def nodes(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, depth) of every internal node of at least least words, children before parents."""
    open_: list[list[int]] = []
    for i, c in enumerate([*common.tolist()[1:], 0], 1):
        first = i - 1
        while open_ and open_[-1][1] > c:
            first, depth = open_.pop()
            yield first, i, depth
        if c >= least and (not open_ or open_[-1][1] < c):
            open_.append([first, c])


def equal_suffixes(words: np.ndarray, starts: np.ndarray, depth: int, limit: int = LIMIT) -> np.ndarray:
    """A number for each start; the same exactly where the next depth words are the same."""
    out = -1 - np.arange(len(starts), dtype=np.int64)
    made = 0
    for group in prefix_groups(words, starts, depth, limit):
        at, common = subtree(words, starts[group], np.full(len(group), depth), depth)
        if len(at):
            # topmost nodes of depth words: runs of suffixes that have so many in common
            node = np.cumsum(np.append(True, common[1:] < depth)) - 1
            out[group[at]] = made + node
            made += int(node[-1]) + 1
    return out


def _window_starts(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.maximum(0, sizes - width + 1)
    first = np.cumsum(sizes) - sizes
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum()), counts


def window_classes(strings: list[bytes], width: int, limit: int = LIMIT) -> list[np.ndarray]:
    """For each string, a class number for each of its windows of width words; equal windows share it."""
    words, sizes = numbered(strings)
    starts, counts = _window_starts(sizes, width)
    return np.split(equal_suffixes(words, starts, width, limit), np.cumsum(counts)[:-1]) if len(strings) else []


def maximal_repeats(strings: list[bytes], width: int, limit: int = LIMIT) -> list[tuple[int, list[tuple[int, int]]]]:
    """(words, occurrences) of every repeat of at least width words that none of its occurrences'
    common neighbours would make longer; an occurrence is (string, first word)."""
    words, sizes = numbered(strings)
    starts, counts = _window_starts(sizes, width)
    first, ends = np.cumsum(sizes) - sizes, np.repeat(np.cumsum(sizes), counts)
    owner = np.repeat(np.arange(len(strings)), counts)
    before = np.where(starts == first[owner], -1 - np.arange(len(starts)), words[starts - 1]) if len(starts) else starts
    out = []
    for group in prefix_groups(words, starts, width, limit):
        at, common = subtree(words, starts[group], (ends - starts)[group], width, whole=True)
        rows = group[at]
        for a, b, depth in nodes(common, width):
            if len(set(before[rows[a:b]].tolist())) > 1:
                out.append((depth, sorted((int(owner[r]), int(starts[r] - first[owner[r]])) for r in rows[a:b])))
    return out
