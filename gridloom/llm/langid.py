"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte n-grams (orders 3 and 4) of the lower-cased text inside word boundaries, hashed
into a fixed number of buckets. A document is the mean of its buckets' embeddings; a linear layer
and a softmax follow. Both matrices are trained by stochastic gradient descent in numpy on the
driver, on a bounded sample of labelled documents; the temperature and the rejection thresholds
come from a part of that sample that training does not see. As mean and linear layer commute,
prediction needs only the table embeddings @ weights: one row of logits for each bucket.

A text is rejected if its score is low, or if too few of its n-grams were met in training: the
softmax only weighs the learned languages against each other, and says nothing with one of them.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from gridloom.llm.common import column, few, lean

BUCKETS = 1 << 16
DIM = 16
#: Labelled documents a language, and of all languages together, that the classifier is fitted on at
#: most. Every language is learned: the more there are, the fewer documents of each.
SAMPLE_PER_LANG, SAMPLE = 1500, 12_000
#: Buckets of a labelled document that are learned from: those with the largest shares. With the
#: bound above it bounds what the driver gathers.
FEATURES = 8192
EPOCHS = 6
#: Texts are turned into features in pieces of about so many bytes at once.
CHUNK = 1 << 20
#: Accepted predictions must reach this accuracy on the calibration part.
TARGET = 0.98
#: The share of rightly predicted calibration texts that the rejection thresholds are taken below of.
LOW = 0.002

#: ASCII bytes that are not letters count as word boundaries.
_BOUNDARY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _buckets(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every byte position, the bucket of the 3-gram and of the 4-gram that start there.

    n-grams with a boundary anywhere but at their ends share bucket 0, whose weight is zero.
    """
    b = np.frombuffer(data + b"   ", np.uint8).astype(np.uint32)
    n = len(data)
    blank = b == 32
    c3 = (b[:n] << np.uint32(16)) | (b[1 : n + 1] << np.uint32(8)) | b[2 : n + 2]
    c4 = (c3 << np.uint32(8)) | b[3 : n + 3]
    out = []
    for code, inner in ((c3, blank[1 : n + 1]), (c4, blank[1 : n + 1] | blank[2 : n + 2])):
        h = (code * np.uint32(2654435761)) ^ (code >> np.uint32(15))
        h = ((h * np.uint32(2246822519)) >> np.uint32(16)).astype(np.int32) % (BUCKETS - 1) + 1
        h[inner] = 0
        out.append(h)
    return out[0], out[1]


def _prepared(text: str | None) -> bytes:
    return b" " + (text or "").lower().encode("utf-8", "replace").translate(_BOUNDARY) + b" "


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    data = _prepared(text)
    for at in range(0, len(data), CHUNK):
        for h in _buckets(data[at : at + CHUNK]):
            counts += np.bincount(h, minlength=BUCKETS)
    counts[0] = 0
    ids = np.flatnonzero(counts)
    return ids.astype(np.int32), (counts[ids] / max(1, counts.sum())).astype(np.float32)


class Model:
    """Languages, embeddings and weights, temperature and thresholds: what prediction needs.

    The table has a row for each bucket: its logits where the languages are fewer than the embedding's
    dimensions, else its embedding, and out has the weights that make logits of a mean. So its size
    doesn't grow with the languages. Its last column is 1 for buckets met in training.
    """

    def __init__(self, langs: list[str], emb: np.ndarray, out: np.ndarray, met: np.ndarray, temperature: float = 1.0, threshold: float = 1.0, least_met: float = 1.0):
        few = out.shape[1] <= out.shape[0]
        self.langs, self.table, self.out = langs, np.column_stack([emb @ out if few else emb, met]).astype(np.float32), None if few else out
        self.temperature, self.threshold, self.least_met = temperature, threshold, least_met

    def means(self, texts: list) -> np.ndarray:
        """A row for each text: logits, and the share of its n-grams that were met in training."""
        x = self._means(texts)
        return x if self.out is None else np.column_stack([x[:, :-1] @ self.out, x[:, -1]])

    def _means(self, texts: list) -> np.ndarray:
        out, batch, size = [], [], 0
        for t in texts:
            data = _prepared(t)
            if len(data) > CHUNK:
                out.append(self._of(batch))
                batch, size = [], 0
                total, n = np.zeros(self.table.shape[1]), 0
                for at in range(0, len(data), CHUNK):
                    s, k = self._sums([data[at : at + CHUNK]])
                    total, n = total + s[0], n + k[0]
                out.append((total / max(1, n))[None, :])
                continue
            batch.append(data)
            size += len(data)
            if size >= CHUNK:
                out.append(self._of(batch))
                batch, size = [], 0
        out.append(self._of(batch))
        return np.concatenate(out)

    def _of(self, batch: list[bytes]) -> np.ndarray:
        if not batch:
            return np.zeros((0, self.table.shape[1]))
        sums, n = self._sums(batch)
        return sums / np.maximum(1, n)[:, None]

    def _sums(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in batch])
        starts = np.cumsum(sizes) - sizes
        sums, n = np.zeros((len(batch), self.table.shape[1])), np.zeros(len(batch))
        for h in _buckets(b"".join(batch)):
            n += np.add.reduceat((h > 0).astype(np.float32), starts)
            for k in range(self.table.shape[1]):
                sums[:, k] += np.add.reduceat(self.table[:, k][h], starts)
        return sums, n

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and whether the text is rejected, for each text: its score is
        below the threshold, or the share of its n-grams that were met in training is too low.

        Null texts and texts without a letter: ("und", 0, True). If no language was learned nothing
        can be judged, and every other text is ("und", 0, False).
        """
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.array([not has_letter(t) for t in texts], bool)
        means = self.means(texts)
        p = softmax(means[:, :-1] / self.temperature)
        best, known = p.argmax(1), np.array([has_letter(t) for t in texts], bool)
        score = np.where(known, p.max(1), 0.0) if len(texts) else np.zeros(0)
        return [self.langs[k] if ok else "und" for k, ok in zip(best, known, strict=True)], score, ~known | (score < self.threshold) | (means[:, -1] < self.least_met)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    return e / e.sum(1, keepdims=True) if len(z) else z


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7, epochs: int = EPOCHS, rate: float = 2.0) -> Model:
    """Fit on (buckets, shares, language) rows; every tenth row calibrates instead."""
    langs = sorted({lang for _, _, lang in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, DIM)), np.zeros((DIM, 0)), np.zeros(BUCKETS))
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    emb[0] = 0
    out = np.zeros((DIM, len(langs)))
    number = {lang: k for k, lang in enumerate(langs)}
    order = rng.permutation(len(rows))
    held, fit = (order[::10], np.delete(order, np.s_[::10])) if len(rows) >= 20 else (order, order)
    steps, done = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for r in rng.permutation(fit):
            ids, share, lang = rows[r]
            step = rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            x = share @ emb[ids]
            g = softmax((x @ out)[None, :])[0]
            g[number[lang]] -= 1
            back = out @ g
            out -= step * np.outer(x, g)
            emb[ids] -= step * share[:, None] * back[None, :] * len(ids) ** 0.5
    z = np.array([(share @ emb[ids]) @ out if len(ids) else np.zeros(len(langs)) for ids, share, _ in (rows[r] for r in held)])
    truth = np.array([number[rows[r][2]] for r in held])
    heats = np.geomspace(0.02, 20, 60)
    # half of one text and half of another language's count as both: without them separable
    # languages would drive the temperature to its least, and every score to 1
    other = rng.permutation(len(truth))
    both = truth != truth[other]
    zs = np.concatenate([z, (z[both] + z[other][both]) / 2])
    one, two = np.concatenate([truth, truth[both]]), np.concatenate([truth, truth[other][both]])
    at = np.arange(len(zs))
    loss = [-sum(np.log(np.maximum(1e-12, softmax(zs / t)[at, y])).mean() for y in (one, two)) for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = softmax(z / heat)
    score, right = p.max(1), p.argmax(1) == truth
    # texts a bucket; those that calibrate what they were fitted on do not count themselves
    met = np.bincount(np.concatenate([rows[r][0] for r in fit]), minlength=BUCKETS)
    own = held is fit
    share_met = np.array([share[met[ids] > own].sum() for ids, share, _ in (rows[r] for r in held)])
    return Model(langs, emb, out, met > 0, heat, accept_from(score, right), least_met(share_met[right]))


def accept_from(score: np.ndarray, right: np.ndarray) -> float:
    """The score from which calibration texts are accepted; above 1 if no score reaches TARGET.

    It is the least from which TARGET of them are right, but not below the low quantile of right
    ones (with half its log-odds where it is better than even, as few texts tell little of a tail).
    """
    down = np.argsort(-score, kind="stable")
    ordered = score[down]
    last = np.append(ordered[1:] < ordered[:-1], True)  # equal scores are accepted together
    reached = np.flatnonzero(last & (np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= TARGET))
    if not len(reached):
        return float(np.nextafter(1, 2))
    low = float(np.quantile(score[right], LOW, method="lower"))
    if low > 0.5:
        odds = (low / max(1 - low, 1e-12)) ** 0.5
        low = odds / (1 + odds)
    at = [x for x in ordered[reached].tolist() if x >= low]
    if not at:
        return float(np.nextafter(1, 2))
    return low if min(at) == score[score >= low].min() else min(at)


def least_met(share: np.ndarray) -> float:
    """The least share of n-grams met in training: twice the unmet ones of the low quantile are
    allowed, but never none at all."""
    low = float(np.quantile(share, LOW, method="lower")) if len(share) else 1.0
    return max(2 * low - 1, np.finfo(np.float32).tiny)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = SAMPLE_PER_LANG, most: int = SAMPLE) -> Model:
    """Train on labelled rows of docs whose crc32 of the key mod 4 is not 2.

    About per_lang rows of each language are taken, by a hash of the key, and fewer where there are
    so many languages that all together would be more than most; features are counted on the executors
    over whole texts, so that the driver gets a bounded number of sparse rows. Every language is
    learned; more languages than most are an error: such a column holds something else. Rows with a null key, text
    or language teach nothing.
    """
    rows = docs.select(column(key).alias("k"), column(text).cast("string").alias("t"), column(lang).cast("string").alias("y"))
    rows = rows.where(F.col("y").isNotNull() & F.col("t").isNotNull() & F.col("k").isNotNull() & ~held_out(F.col("k")))
    found = rows.groupBy("y").count().orderBy("y").limit(most + 1).collect()
    if not found:
        return train([])
    if len(found) > most:
        raise ValueError(f"column {lang} has more than {most} values: these are no languages")
    quota = min(per_lang, max(1, most // len(found)))
    slots = 1 << 30
    wanted = docs.sparkSession.createDataFrame([(r["y"], min(slots, -(-quota * slots // r["count"]))) for r in found], "y string, slots long")
    # a row a language, most at most: bounded, whatever the corpus
    picked = rows.join(F.broadcast(wanted), "y").where(F.pmod(F.xxhash64("k"), F.lit(slots)) < F.col("slots"))

    def count(batches):
        for b in batches:
            for k, t, y in zip(b["k"].to_pylist(), b["t"].to_pylist(), b["y"].to_pylist(), strict=True):
                ids, share = features(t)
                if len(ids) > FEATURES:
                    top = np.sort(np.argsort(-share, kind="stable")[:FEATURES])
                    ids, share = ids[top], share[top]
                yield pa.RecordBatch.from_pydict({"k": [k], "y": [y], "ids": [ids.tobytes()], "share": [share.tobytes()]}, pa.schema([("k", pa.int64()), ("y", pa.string()), ("ids", pa.binary()), ("share", pa.binary())]))

    sample = picked.select(F.col("k").cast("long").alias("k"), "t", "y").mapInArrow(lean(count), "k long, y string, ids binary, share binary").collect()
    sample.sort(key=lambda r: (r["k"], r["y"], bytes(r["ids"])))
    return train([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["share"], np.float32), r["y"]) for r in sample])


def held_out(key):
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _predicted(docs: DataFrame, model: Model, text: str, columns: tuple[str, ...]) -> DataFrame:
    """c0, c1, ... (columns of docs, whatever their names), lang_pred, score and rejected.

    Texts are taken whole, a batch at a time; the model travels once to each executor
    (its size is BUCKETS x DIM numbers at most, whatever the corpus).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*[column(c).alias(f"c{k}") for k, c in enumerate(columns)], column(text).cast("string").alias("_t"))

    def predict(batches):
        m = shared.value
        for b in few(batches):
            lang, score, rejected = m.predict(b.column(b.num_columns - 1).to_pylist())
            arrays = [*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names[:-1], "lang_pred", "score", "rejected"])

    kinds = [("lang_pred", StringType()), ("score", DoubleType()), ("rejected", BooleanType())]
    return given.mapInArrow(lean(predict), StructType([*given.schema.fields[:-1], *[StructField(n, t) for n, t in kinds]]))


def with_language(docs: DataFrame, model: Model, text: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """columns of docs, then lang_pred, score and rejected; the text is the only input. Columns of
    these three names stay beside the new ones if they are asked for."""
    return _predicted(docs, model, text, columns).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "lang_pred", "score", "rejected")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: a row for each row of docs.

    held_out rows take no part in training. Rows without a key count as not held out. Null texts and
    texts without a letter (empty ones too) are "und" with score 0. Repeated rows are predicted alike;
    an empty table gives no rows.
    """
    out = with_language(docs, fit(docs), columns=("doc_id",))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose language is recognised (not rejected).

    Where no language was learned, those with a letter. An error, rather than no rows, where the
    model accepts nothing. Null and empty texts go; repeated rows are judged alike; columns may have
    any name; an empty table stays empty.
    """
    names, model = tuple(docs.columns), fit(docs)
    if model.langs and model.threshold > 1:
        raise ValueError(f"no score of the language model makes {TARGET:.0%} of its predictions right: check the labels")
    return _predicted(docs, model, "text", names).where(~F.col("rejected")).select(*[f"c{k}" for k in range(len(names))]).toDF(*names)
