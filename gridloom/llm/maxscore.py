"""Exact top-k inner products by MaxScore over postings of integer weights.

Vectors are documents whose terms are their components. A shard keeps, for each term, the postings
of its candidates and the largest and smallest weight among them; with a query's weight these bound
what the term can add. Terms are taken in falling order of bound. Those whose bounds alone could
not lift a candidate to the current k-th score are non-essential; the essential ones are traversed
in full, the others are probed only for candidates that can still compete, best bounds first.
A shard gives its own k best for each query; merging the shards' lists gives the exact answer.

Queries are written once to the shared folder; candidates are dealt out once, evenly, and a task
takes them a shard at a time past all queries, which it reads in blocks. Neither side is copied by a
shuffle or broadcast, no key decides where a row goes, and a task holds one shard and one block.
"""

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import lean, partitions, stage

K = 20
SCALE = 64.0
#: Queries in a block, and candidates in a shard.
QUERY_BLOCK, SHARD = 4096, 32768
#: Candidates that give each query a first floor.
PROBE = 2048
#: Candidates that are scored together.
TILE = 2048


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """key and v: floor(scale * component), each component taken as a double.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows
    without a key. Rows that repeat a key are candidates of their own, each ranked.
    """
    x = F.col(f"`{vector}`")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    rows = vectors.where(x.isNotNull() & fine & F.col(f"`{key}`").isNotNull())
    return rows.select(F.col(f"`{key}`").cast("long").alias("key"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"))


def magnitude(v: np.ndarray) -> int:
    """The largest absolute value, as a number without bounds."""
    return max(int(v.max(initial=0)), -int(v.min(initial=0)))


class Shard:
    """Postings of some candidates: by term, the candidates that have it and their weights."""

    def __init__(self, keys: np.ndarray, vectors: list):
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        width = max((len(v) for v in vectors), default=0)
        big = max((magnitude(v) for v in vectors), default=0)
        #: 32 bits hold every score if the weights are small; callers ask for 64 otherwise
        self.big, self.width = big, width
        self.weights = np.zeros((width, len(keys)), np.int64)
        for at, k in enumerate(order):
            self.weights[: len(vectors[k]), at] = vectors[k]
        self.tiles = []
        for at in range(0, len(keys), TILE):
            w = np.ascontiguousarray(self.weights[:, at : at + TILE])
            self.tiles.append((at, w, w.max(1, initial=0), w.min(1, initial=0), w.astype(np.float64)))

    def top(self, query: np.ndarray, own, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the k best candidates, but for the key own, smaller keys first among ties;
        those below floor, where there is one, may be left out. An error where a score may not fit 64 bits."""
        known = floor
        keys, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        terms = np.flatnonzero(query[: self.width])
        most = magnitude(query) * self.big * max(1, len(terms))
        if most >= 1 << 63:
            raise OverflowError("inner products of these weights may not fit 64 bits")
        exact = most < 1 << 53
        for at, w, high, low, dense in self.tiles:
            q = query[terms]
            bound = np.maximum(q * high[terms], q * low[terms])
            order = np.argsort(-bound, kind="stable")
            rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
            floor = max(known, int(scores[-1])) if len(scores) == k and known is not None else scores[-1] if len(scores) == k else known
            # essential: the shortest prefix after which the bounds that remain are below what the
            # essential part leaves typically open; at least one, all while no k-th score is known
            n = len(order) if floor is None else int(np.searchsorted(-rest, -max(1, floor), side="left"))
            n = min(len(order), max(n, 1)) if len(order) else 0
            first = terms[order[:n]]
            score = (query[first].astype(np.float64) @ dense[first]).astype(np.int64) if exact else (query[first, None] * w[first]).sum(0)
            alive = np.arange(w.shape[1])
            while n < len(order):
                if floor is not None:
                    fits = score + rest[n] >= floor
                    score, alive = score[fits], alive[fits]
                if not len(alive):
                    break
                few = terms[order[n : n + 8]]
                score = score + (query[few, None] * w[few][:, alive]).sum(0)
                n += len(few)
            if floor is not None and len(alive):
                fits = score >= floor
                score, alive = score[fits], alive[fits]
            if len(score) > 4 * k:
                cut = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                fits = score >= cut
                score, alive = score[fits], alive[fits]
            new = self.keys[at + alive]
            other = np.ones(len(new), bool) if own is None else new != own
            keys, scores = np.concatenate([keys, new[other]]), np.concatenate([scores, score[other]])
            best = np.lexsort((keys, -scores))[:k]
            keys, scores = keys[best], scores[best]
        return keys, scores


FOUND = "q long, query_id long, vec_id long, score long, own boolean"
_FOUND = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("own", pa.bool_())])


def _flat(column: pa.ListArray) -> list[np.ndarray]:
    """The vectors of a list column, without a Python number for each component."""
    ends = column.offsets.to_numpy()
    return np.split(column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], ends[1:-1] - ends[0]) if len(column) else []


def _floors(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """queries with floor, the k-th best score among PROBE candidates: no list of all candidates ends below
    it. Every shard starts from it, so that it prunes from its first tile and sends little that doesn't last."""
    some = [np.array(r["v"], np.int64) for r in candidates.select("v").limit(PROBE).collect()]  # PROBE rows at most
    schema = "q long, key long, v array<long>, floor long"
    if len(some) < k:
        return queries.select("q", "key", "v", F.lit(None).cast("long").alias("floor"))
    shared = queries.sparkSession.sparkContext.broadcast((np.arange(len(some)), some))

    def run(batches):
        s = Shard(*shared.value)
        for b in batches:
            floor = [int(s.top(v, None, k)[1][-1]) for v in _flat(b["v"])]
            yield pa.RecordBatch.from_arrays([b["q"], b["key"], b["v"], pa.array(floor, pa.int64())], names=["q", "key", "v", "floor"])

    return queries.mapInArrow(lean(run), schema)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query over candidates.

    Both frames have (key, v). Ties go to the smaller key. A query is one row: where rows repeat a
    key each has a list of its own, and one candidate with its key and vector is the query itself and
    takes no part; other rows of its key do. Vectors of different lengths meet in the components that
    both have; an empty side gives no rows. Weights whose inner products may not fit 64 bits are an error.
    """
    spark = candidates.sparkSession
    asked = stage(_floors(queries.select(F.monotonically_increasing_id().alias("q"), "key", "v"), candidates, k + 1))
    where = asked._staged

    def meet(batches):
        store, path = fs.FileSystem.from_uri(where)
        files = ds.dataset(path, filesystem=store, format="parquet", exclude_invalid_files=False)
        keys: list = []
        vectors: list = []

        def best():
            s = Shard(np.concatenate(keys), vectors)
            for some in files.to_batches(columns=["q", "key", "v", "floor"], batch_size=block):
                out = []
                for q, key, v, floor in zip(some["q"].to_pylist(), some["key"].to_pylist(), _flat(some["v"]), some["floor"].to_pylist(), strict=True):
                    # one more than asked for: the query itself may be among them
                    found, score = s.top(v, None, k + 1, floor)
                    out.append((np.full(len(found), q), np.full(len(found), key), found, score, (found == key) & (score == int(v @ v))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out, strict=True), _FOUND, strict=True)], schema=_FOUND)

        for b in batches:
            for at in range(0, len(b), shard):
                some = b.slice(at, shard)
                keys.append(some["key"].to_numpy())
                vectors += _flat(some["v"])
                if len(vectors) >= shard:
                    yield from best()
                    keys, vectors = [], []
        if vectors:
            yield from best()

    # round robin: no key, so none is hot
    found = candidates.select("key", "v").repartition(partitions(spark)).mapInArrow(lean(meet), FOUND)
    by = Window.partitionBy("q")
    ranked = found.withColumn("r", F.row_number().over(by.orderBy(F.col("score").desc(), "vec_id"))).where(F.col("r") <= k + 1)
    ranked = ranked.withColumn("self", F.min(F.when(F.col("own"), F.col("r"))).over(by)).where("self IS NULL OR r <> self")
    rank = F.col("r") - F.when(F.col("r") > F.col("self"), 1).otherwise(0)
    return ranked.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64.0::DOUBLE * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
