"""Token-id files: canonical length-limited Huffman codes from global counts, in independent blocks.

A corpus is three things below one folder of the shared store:

* ``code``: one row, the length of each id's code (0: unused); the canonical code follows from it;
* ``blocks``: a row for each block, a run of whole documents of one range partition: its place,
  its documents' keys and sizes, the number of ids before it in its partition, the bits, and the
  bit offset of every STEP-th id (checkpoints), where decoding can start;
* ``parts``: the number of ids in each range partition, from which positions in the whole follow.

Blocks are rows of Parquet, so that Spark's commit protocol covers lost executors and any store
that Spark writes to will do. Decoding walks all checkpoints of a batch of blocks in step: each
step looks up one id a checkpoint in a table indexed by the next MAX_BITS bits.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.blocks import part_keys
from gridloom.llm.common import column, lean, partitions, remove, shared_folder
from gridloom.llm.tokens import Encoder

MAX_BITS = 18
#: Ids between two checkpoints, and ids from which a block is closed.
STEP, BLOCK = 256, 1 << 15


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most limit bits (package-merge); 0 where the count is 0."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        levels.append(by < len(weights))
        both = both[by]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(weights) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        out[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter codes first, then smaller ids."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        # each code is the running sum of 2**-length, written with its own length
        size = lengths[order].astype(np.int64)
        step = np.int64(1) << (MAX_BITS - size)
        codes[order] = (np.cumsum(step) - step) >> (MAX_BITS - size)
    return codes


def lookup(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every value of the next MAX_BITS bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = np.int64(1) << (MAX_BITS - lengths[order].astype(np.int64))
    ids, bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
    n = int(span.sum())
    ids[:n], bits[:n] = np.repeat(order, span), np.repeat(lengths[order], span)
    return ids, bits


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ids, and the bit offset of every STEP-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    # a code of up to 18 bits that starts within a cell of 32 bits ends in it or in the next; the
    # codes that start in one cell lie together, and no two share a bit: a sum puts them in place
    word = codes[ids].astype(np.uint64) << (64 - size - (starts & 31)).astype(np.uint64)
    cell, out = starts >> 5, np.zeros((total >> 5) + 3, np.uint64)
    if len(ids):
        at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        both = np.add.reduceat(word, at)
        out[cell[at]] += both >> np.uint64(32)
        out[cell[at] + 1] += both & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[: (total + 7) >> 3], starts[::STEP].astype("<u8")


def decode_blocks(blocks: list[tuple[bytes, np.ndarray, int]], table: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The ids of blocks of (bits, checkpoints, number of ids), all checkpoints in step."""
    ids, bits = table
    sizes = np.array([len(p) + 8 for p, _, _ in blocks], np.int64)
    data = np.frombuffer(b"".join(p + bytes(8) for p, _, _ in blocks), np.uint8).astype(np.uint32)
    word = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
    base = (np.cumsum(sizes) - sizes) * 8
    at = np.concatenate([c.astype(np.int64) + b for (_, c, _), b in zip(blocks, base, strict=True)])
    lanes = [-(-n // STEP) for _, _, n in blocks]
    out = np.zeros((STEP, len(at)), np.uint32)
    last = len(word) * 8 - 1
    for k in range(STEP):
        top = (word[at >> 3] >> (np.uint32(32 - MAX_BITS) - (at & 7).astype(np.uint32))) & np.uint32((1 << MAX_BITS) - 1)
        out[k] = ids[top]
        at = np.minimum(at + bits[top], last)
    ends = np.cumsum(lanes)
    return [out[:, e - m : e].T.reshape(-1)[:n] for e, m, (_, _, n) in zip(ends, lanes, blocks, strict=True)]


#: A document's ids; or, where first is not null, counts of COUNTED ids from there in n of a task.
TOKENS = "part int, k long, seq long, n long, ids binary, first int"
_TOKENS = pa.schema([("part", pa.int32()), ("k", pa.int64()), ("seq", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("first", pa.int32())])
#: Ids whose counts travel in one row.
COUNTED = 1 << 11


def _in_order(docs: DataFrame, n: int) -> DataFrame:
    """part, k, t: range partitions of about equal size in ascending key order, sorted within.

    The bounds come from a sketch of the keys alone; Spark's own range partitioning would read all
    texts to sample them.
    """
    spark = docs.sparkSession
    bounds = sorted(set(docs.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000).alias("b")).first()["b"] or []))
    keys = part_keys(spark, n)
    part = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("k"))), F.lit(0)) if bounds else F.lit(0)
    rows = docs.withColumn("part", part).withColumn("_key", F.element_at(F.array(*map(F.lit, keys)), F.col("part") + 1))
    return rows.repartition(n, "_key").sortWithinPartitions("part", "k").select("part", "k", "t")


def _tokenised(docs: DataFrame, path: str, pattern: str, end_id: int, n: int, vocabulary: int) -> DataFrame:
    """Whole documents in ascending key order (part numbers the range partitions, seq is the number
    of ids before the document in its partition), and each task's counts of ids."""

    def run(batches):
        encoder = Encoder.of(path, pattern)
        end, width, counts = np.array([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize, np.zeros(vocabulary, np.int64)
        part, seq = None, 0
        for b in batches:
            parts, keys, texts = (b[c].to_pylist() for c in ("part", "k", "t"))
            for at in range(0, len(texts), 256):
                got = [x.tobytes() + end for x in encoder.encode(texts[at : at + 256])]
                counts += np.bincount(np.frombuffer(b"".join(got), encoder.dtype), minlength=vocabulary)
                sizes, starts, own = [len(x) // width for x in got], [], parts[at : at + 256]
                for p, size in zip(own, sizes, strict=True):
                    seq = seq if p == part else 0
                    part = p
                    starts.append(seq)
                    seq += size
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((own, keys[at : at + 256], starts, sizes, got, [None] * len(got)), _TOKENS, strict=True)], schema=_TOKENS)
        for first in range(0, vocabulary, COUNTED):
            if counts[first : first + COUNTED].any():
                yield pa.RecordBatch.from_pydict({"part": [None], "k": [None], "seq": [None], "n": [None], "ids": [counts[first : first + COUNTED].tobytes()], "first": [first]}, _TOKENS)

    return _in_order(docs, n).mapInArrow(lean(run), TOKENS)


def write_corpus(docs: DataFrame, path: str, pattern: str, end_id: int = 2, key: str = "doc_id", text: str = "text", vocabulary: int | None = None) -> str:
    """Tokenise docs, count ids over all of them, write the files; returns the folder.

    Documents go in ascending key order, those without a key first; rows that repeat a key each
    count. Null text is empty: such a document is its end id alone. An empty table gives files without
    documents. vocabulary is the number of
    ids, that of the tokenizer if none is given; it bounds what the driver gathers: one count an id.
    """
    spark = docs.sparkSession
    if end_id > np.iinfo(Encoder.of(path, pattern).dtype).max:
        raise ValueError(f"end_id {end_id} is larger than the ids that this tokenizer's files hold")
    if vocabulary is None:
        vocabulary = max(max(Encoder.of(path, pattern).library.get_vocab().values()), end_id) + 1
    given = docs.select(column(key).cast("long").alias("k"), column(text).cast("string").alias("t"))
    root, staged = shared_folder(spark), shared_folder(spark)
    _tokenised(given, path, pattern, end_id, partitions(spark), vocabulary).write.option("compression", "zstd").parquet(staged)
    read = spark.read.schema(TOKENS).parquet(staged)
    tokens = read.where("first IS NULL")

    width = Encoder.of(path, pattern).dtype

    def add(batches):
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for first, n in zip(b["first"].to_pylist(), b["ids"].to_pylist(), strict=True):
                total[first : first + COUNTED] += np.frombuffer(n, np.int64)
        yield from _counts(total)

    counts = np.zeros(vocabulary, np.int64)
    parted = read.where("first IS NOT NULL").select("first", "ids").repartition(partitions(spark), "first")
    for r in parted.mapInArrow(lean(add), "first int, n binary").collect():
        counts[r["first"] : r["first"] + COUNTED] += np.frombuffer(bytes(r["n"]), np.int64)
    tokens.groupBy("part").agg(F.sum("n").alias("n")).write.parquet(f"{root}/parts")
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()), MAX_BITS)], "lengths binary, max_bits int").coalesce(1).write.parquet(f"{root}/code")
    code = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def encode(batches):
        # one task has whole files of a partition or several; a block never spans partitions
        size, codes = code.value
        part, first, keys, ids, n = None, 0, [], [], 0
        for b in batches:
            for p, k, seq, x in zip(*(b[c].to_pylist() for c in ("part", "k", "seq", "ids")), strict=True):
                if keys and (p != part or n >= BLOCK or seq != first + n):
                    yield _block(part, first, keys, ids, size, codes)
                    keys, ids, n = [], [], 0
                if not keys:
                    part, first = p, seq
                keys.append(k)
                ids.append(np.frombuffer(x, width))
                n += len(ids[-1])
        if keys:
            yield _block(part, first, keys, ids, size, codes)

    tokens.select("part", "k", "seq", "ids").mapInArrow(lean(encode), BLOCKS).write.parquet(f"{root}/blocks")
    remove(spark, staged)
    return root


def _counts(total: np.ndarray):
    """Rows (first, n) for each run of COUNTED ids that has any."""
    for first in range(0, len(total), COUNTED):
        if total[first : first + COUNTED].any():
            yield pa.RecordBatch.from_pydict({"first": pa.array([first], pa.int32()), "n": [total[first : first + COUNTED].tobytes()]})


BLOCKS = "part int, first long, keys array<bigint>, sizes array<bigint>, bits binary, checkpoints binary"
_BLOCK = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("checkpoints", pa.binary())])


def _block(part, first, keys, ids, size, codes):
    bits, marks = encode_block(np.concatenate(ids), size, codes)
    return pa.RecordBatch.from_pydict({"part": [part], "first": [first], "keys": [keys], "sizes": [[len(x) for x in ids]], "bits": [bits], "checkpoints": [marks.tobytes()]}, _BLOCK)


def read_corpus(spark: SparkSession, root: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) from the files, decoded block by block.

    start is the number of ids of all documents before: those of earlier range partitions (one
    number a partition), then those before it in its own. A corpus without documents gives no rows;
    rows that shared a key each come back.
    """
    row = spark.read.parquet(f"{root}/code").first()
    lengths = np.frombuffer(bytes(row["lengths"]), np.uint8)
    table = spark.sparkContext.broadcast(lengths)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def decode(batches):
        look = lookup(table.value)
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for at in range(0, len(rows), 32):
                few = rows[at : at + 32]
                got = decode_blocks([(bits, np.frombuffer(marks, "<u8"), sum(sizes)) for _, _, _, sizes, bits, marks in few], look)
                out: list = []
                for (part, first, keys, sizes, _, _), ids in zip(few, got, strict=True):
                    at_id = 0
                    for k, n in zip(keys, sizes, strict=True):
                        x = ids[at_id : at_id + n]
                        out.append((k, base.value[part] + first + at_id, n, zlib.crc32(x.astype("<u4")), *([x.astype(np.int32)] if with_ids else [])))
                        at_id += n
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    blocks = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    bases, so_far = {}, 0
    for r in sorted(spark.read.parquet(f"{root}/parts").collect(), key=lambda r: r["part"]):
        bases[r["part"]] = so_far
        so_far += r["n"]
    base = spark.sparkContext.broadcast(bases)
    return blocks.select("part", "first", "keys", "sizes", "bits", "checkpoints").mapInArrow(lean(decode), "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
