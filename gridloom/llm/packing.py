"""Vector bin packing of examples into training sequences.

An example asks for three things at once: tokens, a segment, and loss-bearing tokens. A sequence
has a limit on each. Sequences are filled one by one: of the examples that still fit, the one
whose demand has the largest dot product with the room left (each measured in units of its limit)
goes in, until none fits. Where cutting is allowed, the largest example that is left then gives a
piece that fills the tokens that remain, so only the last sequence of a task can stay open.

Each task packs the documents of its own input partition, a bounded buffer at a time: no shuffle,
and no key that could be hot.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import column, lean
from gridloom.llm.tokens import Encoder

MAX_TOKENS = 2048
MAX_SEGMENTS = 1024
#: Remainders that wait for a sequence at once; each is shorter than a sequence.
BUFFER = 4096


class Packer:
    """Greedy dot-product packing with a bounded set of waiting examples.

    add(item, tokens, loss) hands in an example; out receives (item, skip, tokens, sequence,
    offset) for each piece placed. Loss-bearing tokens are spread evenly over a cut example.
    """

    def __init__(self, out, tokens: int = MAX_TOKENS, segments: int = MAX_SEGMENTS, loss: int | None = None, cut: bool = True, buffer: int = BUFFER):
        self.limits = np.array([tokens, segments, loss or tokens], float)
        self.out, self.cut, self.size, self.sequence = out, cut, buffer, 0
        self.items: list = []

    def add(self, item, tokens: int, loss: int | None = None) -> None:
        loss, skip, top = tokens if loss is None else loss, 0, int(self.limits[0])
        if tokens <= 0:
            return
        if not self.cut and (tokens > top or loss > self.limits[2]):
            raise ValueError(f"an example of {tokens} tokens, {loss} with loss, fits no sequence")
        density = loss / tokens
        whole = min(top, int(self.limits[2] / density)) if density else top
        while tokens - skip >= whole:
            self.out(item, skip, whole, self.sequence, 0)
            self.sequence += 1
            skip += whole
        if tokens > skip:
            self.items.append((item, skip, tokens - skip, density))
        if len(self.items) >= self.size:
            self.pack(keep=len(self.items) // 8)

    def pack(self, keep: int = 0) -> None:
        """Fill sequences while more than keep examples wait."""
        need = np.array([[n, 1, n * d] for _, _, n, d in self.items], float).reshape(-1, 3)
        order = np.lexsort((np.arange(len(need)), -need[:, 2], -need[:, 0]))
        need, items = need[order], [self.items[k] for k in order]
        scaled, waits, left, total = need / self.limits**2, np.ones(len(need), bool), len(need), need.sum(0)
        while left > keep:
            room, offset = self.limits.copy(), 0
            if self.cut and total[0] < self.limits[0] and total[2] <= self.limits[2]:
                self._tail([items[k] for k in np.flatnonzero(waits)])
                waits[:] = False
                break
            while left:
                # examples lie in falling order of tokens: those that are too long come first
                first = int(np.searchsorted(-need[:, 0], -room[0] - 1e-9))
                score = scaled[first:] @ room if room[1] >= 1 else scaled[:0, 0]
                score[~waits[first : first + len(score)] | (need[first : first + len(score), 2] > room[2] + 1e-9)] = -1
                k = first + int(np.argmax(score)) if len(score) else -1
                if k >= 0 and score[k - first] >= 0:
                    item, skip, n, _ = items[k]
                    self.out(item, skip, n, self.sequence, offset)
                    waits[k] = False
                    left -= 1
                    total -= need[k]
                    room -= need[k]
                    offset += n
                    continue
                if self.cut and room[0] >= 1 and room[1] >= 1:
                    k = int(np.flatnonzero(waits)[0])
                    item, skip, n, d = items[k]
                    part = min(n - 1, int(room[0]), int(room[2] / d) if d else n)
                    if part > 0:
                        self.out(item, skip, part, self.sequence, offset)
                        total -= (part, 0, part * d)
                        # what is left of it moves to its place in the order
                        to = int(np.searchsorted(-need[:, 0], -(n - part), side="right")) - 1
                        for x in (need, scaled, waits):
                            x[k:to] = x[k + 1 : to + 1]
                        items[k:to] = items[k + 1 : to + 1]
                        items[to] = (item, skip + part, n - part, d)
                        need[to], waits[to] = (n - part, 1, (n - part) * d), True
                        scaled[to] = need[to] / self.limits**2
                break
            self.sequence += 1
        self.items = [items[k] for k in np.flatnonzero(waits)]

    def _tail(self, items: list) -> None:
        """What is left is less than one sequence: powers of two, which need no padding; a sequence
        whose segments run out before ends there."""
        left, used, pieces = sum(n for _, _, n, _ in items), 0, 0
        goal = 1 << left.bit_length() >> 1
        for item, skip, n, _ in items:
            while n:
                part = min(n, goal - used)
                self.out(item, skip, part, self.sequence, used)
                skip, n, used, left, pieces = skip + part, n - part, used + part, left - part, pieces + 1
                if used == goal or pieces >= self.limits[1]:
                    goal, used, pieces, self.sequence = 1 << left.bit_length() >> 1, 0, 0, self.sequence + 1

    def close(self) -> None:
        self.pack()


def pack_examples(examples: DataFrame, item: str, tokens: str = "tokens", loss: str = "loss", max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = False) -> DataFrame:
    """item, skip, tokens, sequence_id, offset for examples of given sizes (instruction data).

    Null or non-positive sizes take no place and give no row; null loss counts as all tokens. A null
    item is an item like any other, and repeated ones are examples of their own; equal sizes go in
    order of arrival; an empty table gives no rows.
    """
    given = examples.select(F.col(f"`{item}`").cast("string").alias("item"), F.coalesce(F.col(f"`{tokens}`").cast("long"), F.lit(0)).alias("n"), F.col(f"`{loss}`").cast("long").alias("loss"))

    def run(batches):
        rows: list = []
        base = TaskContext.get().partitionId() << 40
        packer = Packer(lambda *x: rows.append(x), max_tokens, max_segments, max_loss, cut)
        for b in batches:
            for x, n, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                packer.add(x, n, y)
            yield from _examples(rows, base)
        packer.close()
        yield from _examples(rows, base)

    return given.mapInArrow(lean(run), "item string, skip long, tokens long, sequence_id long, offset long").withColumnRenamed("item", item)


def _examples(rows: list, base: int):
    if rows:
        a = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a[0], pa.string()), *(pa.array(a[k], pa.int64()) for k in (1, 2)), pa.array([base + s for s in a[3]], pa.int64()), pa.array(a[4], pa.int64())], names=["item", "skip", "tokens", "sequence_id", "offset"])
        rows.clear()


#: A sequence of conversations holds at most so many tokens, conversations, and tokens that bear loss.
CHAT = {"max_tokens": 8192, "max_segments": 6, "max_loss": 4096}


def conversation_sizes(turns: DataFrame, path: str, pattern: str, key: str = "conv_id", role: str = "role", text: str = "text", learned: str = "assistant") -> DataFrame:
    """key, tokens, loss: what each conversation asks for. Every turn ends in an id of its own; those of
    the learned role bear loss.

    Turns are tokenised where they are, and only their sizes are summed up by conversation. Null text is
    empty; a null role bears no loss; turns without a key are one conversation; an empty table gives no rows.
    """
    given = turns.select(column(key).cast("long").alias("k"), F.coalesce(column(role) == learned, F.lit(False)).alias("learned"), column(text).cast("string").alias("t"))

    def run(batches):
        encoder = Encoder.of(path, pattern)
        for b in batches:
            n = [len(x) + 1 for x in encoder.encode(b["t"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["k"], b["learned"], pa.array(n, pa.int64())], names=["k", "learned", "n"])

    sizes = given.mapInArrow(lean(run), "k long, learned boolean, n long")
    return sizes.groupBy(F.col("k").alias(key)).agg(F.sum("n").alias("tokens"), F.coalesce(F.sum(F.when(F.col("learned"), F.col("n"))), F.lit(0)).alias("loss"))


def pack_conversations(turns: DataFrame, path: str, pattern: str, **limits) -> DataFrame:
    """conv_id, skip, tokens, sequence_id, offset: conversations packed under limits on tokens, conversations
    and tokens that bear loss (CHAT unless given). Longer ones are cut; see conversation_sizes for nulls."""
    sizes = conversation_sizes(turns, path, pattern)
    return pack_examples(sizes, "conv_id", cut=True, **CHAT | limits).withColumn("conv_id", F.col("conv_id").cast("long"))


#: Words whose ids a packing task keeps (some 60 MB); none are kept when it ends.
WORDS = 250_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, path: str, pattern: str, end_id: int = 1, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of whole tokenised documents (each with end_id appended), packed into sequences.

    A row for each piece: where it starts in its document, its length, the crc32 of its ids, the
    document's tokens, and where it lies. with_ids adds the ids themselves. Null text is empty, so
    such a document is its end id alone. Every row of docs is a document of its own, repeated keys
    too; an empty table gives no pieces. sequence_id is the task's partition number and a count within it, so that a repeated task
    gives the same rows.
    """
    given = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        encoder, rows = Encoder.of(path, pattern), []

        def placed(doc, skip, n, sequence, offset):
            k, ids = doc
            part = ids[skip : skip + n]
            rows.append((k, skip, n, zlib.crc32(part), len(ids), base + sequence, offset, *([part.view(np.int32)] if with_ids else [])))

        def flush():
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows.clear()

        packer = Packer(placed)
        try:
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    keys, texts = (c.to_pylist() for c in b.slice(at, 256).columns)
                    for k, ids in zip(keys, encoder.encode(texts), strict=True):
                        ids = np.append(ids.astype("<u4"), np.array([end_id], "<u4"))
                        packer.add((k, ids), len(ids))
                    encoder.forget(WORDS)
                    yield from flush()
        finally:
            encoder.forget()
        packer.close()
        yield from flush()

    return given.mapInArrow(lean(run), PIECES + (", ids array<int>" if with_ids else ""))
