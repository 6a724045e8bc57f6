"""Byte-level BPE as a monoid: encode halves, join neighbours at their boundary.

A sequence of tokens is what greedy merging makes of its bytes exactly if each two neighbours are
what it makes of theirs. So the encodings of two halves join by re-encoding a window around the
boundary and growing it until its outer tokens agree with their neighbours outside: all pairs
outside the window are unchanged, all within come from one encoding, and the two at its rims are
tested. The join is associative, with the empty sequence as its neutral element, so that any tree
over the pieces gives the same ids. The tree here halves every word that is no token itself, down
to its tokens; short pieces and pairs of tokens, which come again and again, are remembered.

The vocabulary must be one that merging can reach: every token encodes to itself, and single bytes
are tokens.
"""

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tokens import WordCache, is_narrow, narrow

#: Tokens on either side of a boundary that the first window takes: a pair, which is remembered.
WINDOW = 1
#: Windows of up to so many bytes, and those that take in all of both sides, are merged directly.
DIRECT = 192
#: Direct merging looks through all pairs for the next up to so many bytes; beyond, a heap holds them.
SCAN = 64
#: Pieces of up to so many bytes are remembered, and so many of them, and of pairs of tokens.
SHORT, KEPT = 8, 400_000
#: Pieces of a long word of so many bytes or more are remembered while it is encoded: where it repeats
#: itself, its halves and the windows at their boundaries come again and again.
LARGE = 48
#: Tokens that a leaf of the decoding tree looks up.
DECODE_LEAF = 4096


class Codec:
    """Encoding and decoding by a file of base64 tokens and ranks."""

    _loaded: dict[str, "Codec"] = {}

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.split, self.split_any = narrow(pattern), regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.pieces: dict[bytes, list[int]] = {}
        self.large: dict[bytes, list[int]] = {}
        self.cache = WordCache(lambda word: array("I", self.word(word.encode())).tobytes())

    @classmethod
    def of(cls, path: str, pattern: str) -> "Codec":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path, pattern)
        return cls._loaded[path]

    def leaf(self, data: bytes) -> list[int]:
        """Merge directly: of all neighbours that form a token, always the first of lowest rank."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > SCAN:
            return self._heaped(data)
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        scores = [rank(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s < best):
                    best, at = s, i
            if best is None:
                return [self.ranks[p] for p in parts]
            parts[at] += parts[at + 1]
            del parts[at + 1], scores[at]
            if at:
                scores[at - 1] = rank(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = rank(parts[at] + parts[at + 1])

    def _heaped(self, data: bytes) -> list[int]:
        """leaf, where looking through all pairs for each merge would take too long."""
        rank, n = self.ranks.get, len(data)
        # a part starts at i and ends where the next one starts; before[i] is where the last one does
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waits = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapify(waits)
        while waits:
            _, i, until = heappop(waits)
            middle = after[i]
            # entries of parts that have changed since are passed over
            if middle <= i or middle >= n or after[middle] != until:
                continue
            after[i], after[middle] = until, -1
            if until < n:
                before[until] = i
                if (r := rank(data[i : after[until]])) is not None:
                    heappush(waits, (r, i, after[until]))
            if i and (r := rank(data[before[i] : until])) is not None:
                heappush(waits, (r, before[i], until))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : after[i]]])
            i = after[i]
        return out

    def word(self, data: bytes) -> list[int]:
        """encode, and then forget the word's large pieces."""
        out = self.encode(data)
        self.large.clear()
        return out

    def encode(self, data: bytes) -> list[int]:
        """The ids of one word: halves are encoded by themselves and joined."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        if n >= LARGE:
            known = self.large.get(data)
            if known is None:
                known = self.large[data] = self.join(self.encode(data[: n // 2]), self.encode(data[n // 2 :]))
            return known
        if n > SHORT:
            return self.join(self.encode(data[: n // 2]), self.encode(data[n // 2 :]))
        known = self.pieces.get(data)
        if known is None:
            if len(self.pieces) >= KEPT:
                self.pieces.clear()
            known = self.pieces[data] = self.join(self.encode(data[: n // 2]), self.encode(data[n // 2 :])) if n else []
        return known

    def pair(self, a: int, b: int) -> list[int]:
        """What merging makes of the bytes of two tokens; they are compatible if it leaves them as they are."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self.leaf(self.tokens[a] + self.tokens[b])
        return known

    def compatible(self, a: int, b: int) -> bool:
        return self.pair(a, b) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the concatenation of what left and right encode; neither is changed."""
        if not left or not right:
            return left or right
        inner = self.pair(left[-1], right[0])
        if inner == [left[-1], right[0]]:
            return left + right
        i, j, step = len(left) - WINDOW, WINDOW, WINDOW
        while True:
            grown = False
            if i and not self.compatible(left[i - 1], inner[0]):
                i, grown = max(0, i - step), True
            if j < len(right) and not self.compatible(inner[-1], right[j]):
                j, grown = min(len(right), j + step), True
            if not grown:
                return left[:i] + inner + right[j:]
            step *= 2
            data = b"".join([self.tokens[t] for t in left[i:]] + [self.tokens[t] for t in right[:j]])
            inner = self.leaf(data) if len(data) <= DIRECT or i == 0 and j == len(right) else self.encode(data)

    def decode(self, ids) -> bytes:
        """Bytes of ids: each half by itself, then concatenated, up the tree."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def encode_texts(self, texts: list) -> list[np.ndarray]:
        """Ids of whole texts: every match of the pattern is a word; new words are encoded once."""
        return [np.frombuffer(self.cache.ids((self.split if is_narrow(t) else self.split_any)(t)) if t else b"", "<u4") for t in texts]


def encode_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded) for every row of docs.

    The text is encoded whole, and the ids are decoded again. Null text is empty; repeated keys and
    null keys are rows like any other; an empty table gives no rows. Each row depends on itself alone:
    no shuffle.
    """
    given = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if with_ids else [])
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()] + ([pa.list_(pa.int32()), pa.binary()] if with_ids else [])

    def run(batches):
        codec = Codec.of(path, pattern)
        for b in batches:
            keys, texts = b["k"].to_pylist(), b["t"].to_pylist()
            for at in range(0, len(texts), 256):
                rows = []
                for k, ids in zip(keys[at : at + 256], codec.encode_texts(texts[at : at + 256]), strict=False):
                    data = codec.decode(ids.tolist())
                    rows.append((k, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(data).hexdigest(), *([ids.view(np.int32), data] if with_ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return given.mapInArrow(run, f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else ""))
