"""Removal of windows that repeat across documents: the part that words and bytes share.

A document is a sequence of symbols. A window of ``width`` symbols is removed from a document if
it also starts in one with a smaller id. To bring equal windows together without a row for each:

1. Every window has an anchor, the gram of ``gram`` symbols within it whose hash is least; equal
   windows have equal anchors at equal places. Blocks of anchors' hashes find those that two
   documents have. A window whose anchor is in one document only cannot repeat.
2. The runs of windows that share a repeating anchor are sent, as strings, to the part of the hash
   space of their anchor; equal ones of one batch of texts travel once. A part joins equal strings;
   the distinct ones go to the operator's own method, which says which of their windows are equal:
   merged Burrows-Wheeler transforms for bytes (the shards are what the sending tasks gave),
   prefix-partitioned suffix trees for words.
3. The least document of each class follows, and with it what every other document loses. Ranges
   return to the documents in blocks.

Documents whose whole text equals that of one with a smaller id lose every window; the sequences
above are those of the others alone. Texts are dealt out by document id once; anchors, strings
and the final cut read that same exchange.

Where rows share an id, each row goes through all this under a number of its own, with the id as
its owner; what has the same owner does not lose to each other.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.blocks import DOCS, MESSAGE, by_part, gathered, low48, messages, mix, pack48, part_keys, part_of, per_document, runs, shared_entries, unpack48
from gridloom.llm.common import ROW, column, lean, partitions, release, repeats, rows_of, stage
from gridloom.llm.words import _BASE, _BYTE, _SPACE, Words

#: Bytes of text whose symbols are looked at together, and bytes of strings that are merged at once.
CHUNK, GROUP = 1 << 19, 3 << 16
_MAX = np.uint64((1 << 64) - 1)


@dataclass(frozen=True)
class Kind:
    """What a document's symbols are: layout(texts) gives a Layout; classes(strings, width) the method.

    sharded says that the method merges shards: it gets strings by anchor, about GROUP bytes at a
    time, and as shard the task that sent each. Otherwise it gets all strings of a part, and bounds
    its own memory.
    """

    width: int
    gram: int
    layout: Callable
    classes: Callable
    sharded: bool


class Layout:
    """Symbols of some texts one after another: hash and document of each, and the bytes from
    ``begin[i]`` to ``until[j]`` that a run of symbols i..j is sent as."""

    def __init__(self, symbol, doc, first, data, begin, until):
        self.symbol, self.doc, self.first, self.data, self.begin, self.until = symbol, doc, first, data, begin, until


def bytes_of(texts: list) -> Layout:
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"".join(parts)
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.arange(len(data) + 1)
    return Layout(_BYTE[np.frombuffer(data, np.uint8)], np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes) - sizes, data, at[:-1], at[1:])


def words_of(texts: list) -> Layout:
    w = Words(texts)
    b = np.frombuffer(w.data, np.uint8)
    blank = _SPACE[b]
    # one space between words, whatever white space the text has
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    place = np.cumsum(keep) - 1
    data = np.where(blank, np.uint8(32), b)[keep].tobytes()
    sizes = np.bincount(w.doc, minlength=len(texts)) if len(w.doc) else np.zeros(len(texts), np.int64)
    begin = place[w.start] if len(w.start) else w.start
    return Layout(w.hash, w.doc, np.cumsum(sizes) - sizes, data, begin, begin + (w.end - w.start))


def _rolled(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive symbols."""
    out, have, cur, size, power = None, 0, x, 1, _BASE
    while k:
        if k & 1:
            n = len(x) - have - size + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            out = cur[:n].copy() if out is None else out[:n] * np.uint64(power) + cur[have : have + n]
            have += size
        k >>= 1
        if k:
            cur = cur[:-size] * np.uint64(power) + cur[size:] if len(cur) > size else cur[:0]
            power, size = power * power & (1 << 64) - 1, size * 2
    return mix(out)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def anchors(layout: Layout, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows within one document, the place of each one's anchor, and all gram hashes."""
    n = len(layout.symbol) - kind.width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = _rolled(layout.symbol, kind.gram)
    at = np.arange(len(gram), dtype=np.uint64)
    # of grams of equal least hash the first is the anchor
    least = _least((gram & np.uint64(0xFFFFFFFF00000000)) | at, kind.width - kind.gram + 1)
    start = np.flatnonzero(layout.doc[:n] == layout.doc[kind.width - 1 :])
    return start, (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64), gram


def _groups(batches, columns):
    """Lists of rows, with text as the last of columns, of about CHUNK bytes."""
    rows, size = [], 0
    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in columns), strict=True):
            rows.append(row)
            size += len(row[-1] or "")
            if len(rows) == DOCS or size >= CHUNK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _send_anchors(docs: DataFrame, kind: Kind, keys: list[int]) -> DataFrame:
    def run(batches):
        dst = keys[TaskContext.get().partitionId() % len(keys)]
        for rows in _groups(batches, ["doc_id", "text"]):
            x = kind.layout([t for _, t in rows])
            _, place, gram = anchors(x, kind)
            place = place[np.append(True, place[1:] != place[:-1])] if len(place) else place
            h, doc = gram[place], x.doc[place]
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            fresh = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[: len(h)]
            yield from messages(h[fresh], doc[fresh], np.array([i for i, _ in rows], np.int64), dst, keys)

    return docs.mapInArrow(lean(run), MESSAGE)


def _repeating(answers: DataFrame, n: int) -> DataFrame:
    """doc_id, low: the anchors of each document that another one has, too."""

    def run(batches):
        ids, low, _, _ = gathered(batches)
        out = [(i, pack48(low[a:b])) for i, a, b in per_document(ids)]
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 4096], strict=True), (pa.int64(), pa.binary()), strict=True)], names=["doc_id", "low"])

    return answers.repartition(n, "dst").mapInArrow(lean(run), "doc_id long, low binary")


#: doc, start and which for each occurrence; size, gram and body for each distinct string.
STRINGS = "p int, dst int, ids binary, owner binary, doc binary, start binary, which binary, size binary, gram binary, body binary"
#: Occurrences in one row: which takes two bytes.
_MOST = 1 << 16


def _send_strings(docs: DataFrame, kind: Kind, keys: list[int], owned: bool) -> DataFrame:
    """The runs of windows that share a repeating anchor, from (doc_id, owner if owned, low, text) rows."""
    columns = ["doc_id", *(["owner"] if owned else []), "low", "text"]
    names = [c.split()[0] for c in STRINGS.split(", ")]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 8

    def run(batches):
        dst = keys[TaskContext.get().partitionId() % len(keys)]
        for rows in _groups(batches, columns):
            x = kind.layout([r[-1] for r in rows])
            start, place, gram = anchors(x, kind)
            if not len(start):
                continue
            wanted = np.concatenate([unpack48(low) | np.uint64(k << 48) for k, low in enumerate(r[-2] for r in rows)])
            wanted.sort()
            edge = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
            anchor = place[edge]
            key = low48(gram[anchor]) | (x.doc[anchor].astype(np.uint64) << np.uint64(48))
            found = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
            first = start[edge][found]
            last = start[np.append(edge[1:], len(start)) - 1][found] + kind.width - 1
            h, doc = mix(gram[anchor[found]]), x.doc[first]
            begin, until = x.begin[first], x.until[last]
            ids, out = np.array([r[0] for r in rows], "<i8").tobytes(), []
            owner = np.array([r[1] for r in rows], "<i8").tobytes() if owned else None
            for p, whole in by_part(part_of(h, len(keys)), len(keys)):
                for at in (whole[k : k + _MOST] for k in range(0, len(whole), _MOST)):
                    number: dict[bytes, int] = {}
                    which = np.array([number.setdefault(x.data[a:b], len(number)) for a, b in zip(begin[at].tolist(), until[at].tolist(), strict=True)], "<u2")
                    one = at[np.unique(which, return_index=True)[1]]
                    sizes, grams = np.array([len(s) for s in number], "<u4"), (h[one] >> np.uint64(32)).astype("<u4")
                    out.append((keys[p], dst, ids, owner, doc[at].astype(np.uint8).tobytes(), (first[at] - x.first[doc[at]]).astype("<u4").tobytes(), which.tobytes(), sizes.tobytes(), grams.tobytes(), b"".join(number)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(lean(run), STRINGS)


RANGES = "dst int, ids binary, start binary, until binary"


def _gathered(batches):
    """All strings of a part: the distinct ones with their grams and first sender, and for every
    occurrence its string, document, owner, sender and start. Rows are taken out of their batch a few at a time."""
    number: dict[bytes, int] = {}
    grams, senders, which, ids, owners, dsts, starts = [], [], [], [], [], [], []
    for b in (whole.slice(k, 32) for whole in batches for k in range(0, whole.num_rows, 32)):
        for dst, i, owner, doc, start, own, size, gram, body in zip(*(b[c].to_pylist() for c in ("dst", "ids", "owner", "doc", "start", "which", "size", "gram", "body")), strict=True):
            at, map_ = 0, []
            for n, g in zip(np.frombuffer(size, "<u4").tolist(), np.frombuffer(gram, "<u4").tolist(), strict=True):
                k = number.setdefault(body[at : at + n], len(number))
                if k == len(grams):
                    grams.append(g)
                    senders.append(dst)
                map_.append(k)
                at += n
            which.append(np.array(map_, np.int32)[np.frombuffer(own, "<u2")])
            doc = np.frombuffer(doc, np.uint8)
            ids.append(np.frombuffer(i, "<i8")[doc])
            owners.append(np.frombuffer(owner, "<i8")[doc] if owner is not None else ids[-1])
            starts.append(np.frombuffer(start, "<u4"))
            dsts.append(np.full(len(doc), dst, np.int32))
    if not number:
        return None
    return list(number), np.array(grams, np.uint32), np.array(senders), *map(np.concatenate, (which, ids, owners, dsts, starts))


#: Occurrences whose windows are looked at together, and that share a row of ranges at most.
_FEW, _MANY = 1 << 13, 1 << 16


def _judge(strings: DataFrame, kind: Kind, n: int) -> DataFrame:
    """Ranges of symbols that documents lose, from all strings of a part.

    A part holds its distinct strings and four bytes for each of their windows; what else is as long
    as windows is made for GROUP bytes of strings or _FEW occurrences at a time.
    """

    def run(batches):
        got = _gathered(batches)
        if got is None:
            return
        bodies, grams, senders, which, ids, owners, dsts, starts = got
        del got
        # the order of owners is all that counts
        owners = np.unique(owners, return_inverse=True)[1].astype(np.int32)
        least = np.full(len(bodies), np.iinfo(np.int32).max, np.int32)
        np.minimum.at(least, which, owners)
        # the least document of each window's class, for all distinct strings, and where a string's windows lie
        counts, firsts, windows, have = np.zeros(len(bodies), np.int64), np.zeros(len(bodies), np.int64), [], 0

        def classified(group, found):
            nonlocal have
            sizes = np.array([len(f) for f in found])
            _, flat = np.unique(np.concatenate(found), return_inverse=True)
            low = np.full(int(flat.max(initial=-1)) + 1, np.iinfo(np.int32).max, np.int32)
            np.minimum.at(low, flat, np.repeat(least[group], sizes))
            windows.append(low[flat])
            counts[group], firsts[group] = sizes, have + np.cumsum(sizes) - sizes
            have += len(flat)

        if kind.sharded:
            order = np.argsort(grams, kind="stable")
            group, size = [], 0
            for a, b in runs(grams[order]):
                group += order[a:b].tolist()
                size += sum(len(bodies[k]) for k in order[a:b])
                if size >= GROUP or b == len(order):
                    classified(group, kind.classes([bodies[k] for k in group], kind.width, shard=senders[group]))
                    group, size = [], 0
            del order, group
        else:
            classified(np.arange(len(bodies)), kind.classes(bodies, kind.width))
        del bodies, grams, senders, least
        windows = np.concatenate(windows)

        def lost(few):
            """Document, start and end of the ranges that these occurrences lose."""
            c = counts[which[few]]
            inside = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            gone = windows[np.repeat(firsts[which[few]], c) + inside] < np.repeat(owners[few], c)
            from_ = gone & ~(np.append(False, gone[:-1]) & (inside > 0))
            to = gone & ~(np.append(gone[1:], False) & np.append(inside[1:] > 0, False))
            f, t = np.flatnonzero(from_), np.flatnonzero(to)
            x = np.repeat(few, c)[f]
            return ids[x], starts[x] + inside[f], starts[x] + inside[t] + kind.width

        by = np.argsort(dsts, kind="stable")
        for a, b in runs(dsts[by]):
            for many in np.array_split(by[a:b], max(1, (b - a) // _MANY)):
                parts = [lost(few) for few in np.array_split(many, max(1, len(many) // _FEW))]
                row = [b"".join(x.tobytes() for x in part) for part in zip(*parts, strict=True)]
                if row[0]:
                    yield pa.RecordBatch.from_pydict({"dst": pa.array([int(dsts[many[0]])], pa.int32()), "ids": [row[0]], "start": [row[1]], "until": [row[2]]})

    return strings.repartition(n, "p").mapInArrow(lean(run), RANGES)


def _merged(ranges: DataFrame, n: int) -> DataFrame:
    """doc_id, start, until: each document's lost ranges, joined where they touch, as int64 blocks."""

    def run(batches):
        rows = [r for b in batches for r in zip(*(b[c].to_pylist() for c in ("ids", "start", "until")), strict=True)]
        if not rows:
            return
        ids, start, until = (np.concatenate([np.frombuffer(r[k], np.int64) for r in rows]) for k in range(3))
        order = np.lexsort((start, ids))
        ids, start, until = ids[order], start[order], until[order]
        out = []
        for i, a, b in per_document(ids):
            s, u = start[a:b], np.maximum.accumulate(until[a:b])
            edge = np.append(True, s[1:] > u[:-1])
            out.append((i, s[edge].tobytes(), u[np.append(edge[1:], True)].tobytes()))
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 4096], strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "start", "until"])

    return ranges.repartition(n, "dst").mapInArrow(lean(run), "doc_id long, start binary, until binary")


def _found(docs: DataFrame, kind: Kind, key: str, text: str, owner: str | None, carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """doc_id (the key), text and c0, c1, ... (the carried columns) dealt out by key, with copy; and
    the ranges that those which are no copies lose.

    Keys are unique. Where they are not the documents' ids, owner is, and is kept. Carried columns
    go with the text from the start, so that one exchange of texts serves every step: a column left
    out by one of them would make another exchange of it.
    """
    n = partitions(docs.sparkSession)
    keys = part_keys(docs.sparkSession, n)
    own_id, names = ("owner", ["doc_id", "owner"]) if owner else ("doc_id", ["doc_id"])
    wide = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carried)]
    given = docs.where(F.col(f"`{owner or key}`").isNotNull())
    given = given.select(F.col(f"`{key}`").cast("long").alias("doc_id"), *([F.col(f"`{owner}`").cast("long").alias("owner")] if owner else []), *wide, F.col(f"`{text}`").cast("string").alias("text"))
    named = stage(given.where("text is not null").select(*names, F.sha2("text", 256).alias("digest")))
    # written, so that the join reads two plain exchanges, of which Spark can split a large digest
    first = stage(named.groupBy("digest").agg(F.min(own_id).alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first"))
    copies = stage(named.join(first, "digest").where(f"{own_id} <> first").select("doc_id", F.lit(True).alias("copy")))
    release(named, first)
    dealt = given.repartition(n, "doc_id").join(copies.hint("shuffle_hash"), "doc_id", "left")
    # no condition on text, which would reach the scan and make this another exchange
    own = dealt.where("copy is null")
    low = _repeating(shared_entries(_send_anchors(own, kind, keys), n), n)
    strings = _send_strings(own.join(low.hint("shuffle_hash"), "doc_id"), kind, keys, owner is not None)
    return dealt, _merged(_judge(strings, kind, n), n)


def lost_ranges(docs: DataFrame, kind: Kind, key: str = "doc_id", text: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, copy, start, until (then c0, c1, ...: the carried columns) for every row of docs
    that has a key.

    copy says that a document with a smaller id has the same text; such rows lose all windows
    and have no ranges. start and until are null where nothing is lost. Rows that share a key do
    not lose to each other, but each loses what documents with smaller ids have; null text has no
    symbols; an empty table gives none.
    """
    docs = docs.where(column(key).isNotNull())
    if not carried:
        docs, (key, text) = docs.select(column(key).alias("c0"), column(text).alias("c1")), ("c0", "c1")
    alike = repeats(docs, key)
    dealt, lost = _found(rows_of(docs, key, text), kind, ROW, text, key, carried) if alike else _found(docs, kind, key, text, None, carried)
    out = dealt.join(lost.hint("shuffle_hash"), "doc_id", "left")
    return out.select(F.col("owner" if alike else "doc_id").alias("doc_id"), "text", F.coalesce("copy", F.lit(False)).alias("copy"), "start", "until", *[f"c{k}" for k in range(len(carried))])
