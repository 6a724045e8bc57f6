"""Blocked messages: many small entries (hash, document) travel as a few binary rows.

A task sends, for each of n parts of the hash space, one row that holds the sorted low 48 bits of
hashes and the documents they come from. Whoever receives a part sees all entries of its hashes,
finds those that more than one document has, and answers in rows of the same kind, addressed to
the part ``dst`` of the documents' side. No step has a row for each entry, and none gathers a
document's or a hash's entries anywhere but in blocks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import lean

#: Documents in one message at most: their index takes a byte.
DOCS = 256

MESSAGE = "p int, dst int, ids binary, doc binary, low binary, meta binary"
_MESSAGE = pa.schema([("p", pa.int32()), ("dst", pa.int32()), *((c, pa.binary()) for c in ("ids", "doc", "low", "meta"))])
ANSWER = "dst int, ids binary, doc binary, low binary, df binary, meta binary"
_ANSWER = pa.schema([("dst", pa.int32()), *((c, pa.binary()) for c in ("ids", "doc", "low", "df", "meta"))])


def pack48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def low48(h: np.ndarray) -> np.ndarray:
    return h & np.uint64((1 << 48) - 1)


def part_of(h: np.ndarray, n: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def part_keys(spark: SparkSession, n: int) -> list[int]:
    """A number for each of n parts, such that Spark's hash partitioning sends each to a partition
    of its own: plain numbers would collide, and leave some tasks with several parts and some with none."""
    found: dict[int, int] = {}
    size = 8 * n
    while len(found) < n:
        rows = spark.range(size).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("at"), F.col("id").cast("int").alias("id"))
        found = {r["at"]: r["id"] for r in rows.groupBy("at").agg(F.min("id").alias("id")).collect()}  # a row a part
        size *= 2
    return [found[k] for k in range(n)]


def by_part(part: np.ndarray, n: int):
    """(part, indices of its entries) for each part that has any."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(n + 1))
    for p in np.flatnonzero(ends[1:] > ends[:-1]):
        yield int(p), order[ends[p] : ends[p + 1]]


def messages(h: np.ndarray, doc: np.ndarray, ids: np.ndarray, dst: int, keys: list[int]):
    """Batches of MESSAGE rows for entries of at most DOCS documents; doc indexes ids.

    Hashes are mixed before they choose a part: those of anchors are the least of many.
    """
    head = np.asarray(ids, "<i8").tobytes()
    rows = [(keys[p], dst, head, doc[at].astype(np.uint8).tobytes(), pack48(h[at]), None) for p, at in by_part(part_of(mix(h), len(keys)), len(keys))]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _MESSAGE, strict=True)], schema=_MESSAGE)


def note(ids: np.ndarray, meta: bytes, dst: int, p: int):
    """A MESSAGE row that carries a fixed-size record for each document, and no entries."""
    return pa.RecordBatch.from_pydict({"p": [p], "dst": [dst], "ids": [np.asarray(ids, "<i8").tobytes()], "doc": [b""], "low": [b""], "meta": [meta]}, _MESSAGE)


def shared_entries(sent: DataFrame, n: int) -> DataFrame:
    """ANSWER rows with the entries whose hash comes from two documents or more, and how many (df).

    Entries must be distinct by document and hash.
    """

    def run(batches):
        rows = []
        for b in batches:
            for dst, ids, doc, low, meta in zip(*(b[c].to_pylist() for c in ("dst", "ids", "doc", "low", "meta")), strict=True):
                if meta is not None:
                    yield _answer([(dst, ids, b"", b"", b"", meta)])
                else:
                    rows.append((dst, ids, np.frombuffer(doc, np.uint8), low))
        if not rows:
            return
        low = unpack48(b"".join(r[3] for r in rows))
        rows = [r[:3] for r in rows]
        order = np.argsort(low)
        s = low[order]
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        runs = np.diff(np.append(starts, len(s)))
        del s
        df = np.zeros(len(low), np.uint32)
        df[order] = np.repeat(runs.astype(np.uint32), runs)
        del order
        at, out = 0, []
        for dst, ids, doc in rows:
            d = df[at : at + len(doc)]
            keep = d > 1
            if keep.any():
                out.append((dst, ids, doc[keep].tobytes(), pack48(low[at : at + len(doc)][keep]), d[keep].tobytes(), None))
            at += len(doc)
            if len(out) >= 64:
                yield _answer(out)
                out = []
        if out:
            yield _answer(out)

    return sent.repartition(n, "p").mapInArrow(lean(run), ANSWER)


def _answer(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ANSWER, strict=True)], schema=_ANSWER)


def gathered(batches):
    """(document id, low, df) arrays of all entries in ANSWER batches, sorted by document; and the notes."""
    ids, low, df, notes = [], [], [], []
    for b in batches:
        for i, doc, lo, d, meta in zip(*(b[c].to_pylist() for c in ("ids", "doc", "low", "df", "meta")), strict=True):
            if meta is not None:
                notes.append((np.frombuffer(i, "<i8"), meta))
            else:
                ids.append(np.frombuffer(i, "<i8")[np.frombuffer(doc, np.uint8)])
                low.append(unpack48(lo))
                df.append(np.frombuffer(d, np.uint32))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32), notes
    ids, low, df = np.concatenate(ids), np.concatenate(low), np.concatenate(df)
    order = np.argsort(ids, kind="stable")
    return ids[order], low[order], df[order], notes


def runs(x: np.ndarray):
    """(start, end) of each run of equal values."""
    edge = np.flatnonzero(x[1:] != x[:-1]) + 1
    return zip(np.append(0, edge).tolist(), np.append(edge, len(x)).tolist(), strict=True) if len(x) else ()


def per_document(ids: np.ndarray):
    """(id, start, end) of each run of equal ids."""
    for a, b in runs(ids):
        yield int(ids[a]), int(a), int(b)
