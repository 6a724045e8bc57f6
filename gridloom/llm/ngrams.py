"""N-gram Jaccard join: the blocked sparse product of documents by n-gram incidence.

Rows of the incidence matrix are documents, columns n-grams (hashes of five lower-cased words).
The product with its transpose holds the overlaps; it is never formed whole:

1. Columns are dealt in blocks of the hash space. A block finds the columns with two entries or
   more and their sizes (df); columns with one entry cannot add to any overlap off the diagonal.
2. A row whose shared columns are fewer than three quarters of its size is out: no partner's
   overlap can reach the bound. The others keep their shared columns, rarest first.
3. Within that order two linked rows must meet in their first n - ceil(0.75 n) + 1 columns. Blocks
   of these columns give the candidate pairs, less those whose sizes and places in the order bound
   the overlap below what a link needs. A column's rows are first paired with one hub only; pairs
   with others are formed where the hub turns out not to link to a row.
4. The product's elements at candidates are then computed in tiles: block by block of columns the
   overlaps of all elements of a tile are counted and added up, and an element is discarded as soon
   as its count and the columns left cannot reach the bound. Counts are compared as integers.

Equal sets count as one row until the end. Links give components; only counts and blocks of
hashes move, and no column or component is gathered in one place.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.blocks import DOCS, MESSAGE, by_part, gathered, messages, mix, note, pack48, part_keys, part_of, per_document, runs, shared_entries, unpack48
from gridloom.llm.common import ROW, column, lean, numbered, partitions, release, remove, repeats, rows_of, stage, staged_folders
from gridloom.llm.components import connected
from gridloom.llm.words import Words, grams

NGRAM = 5
#: A link needs 100 * overlap >= PERCENT * union.
PERCENT = 75
#: Bytes of text that are turned into n-grams at once.
CHUNK = 1 << 19
_RECORD = np.dtype([("n", "<i8"), ("k1", "<u8"), ("k2", "<u8")])


def sets(texts: list, k: int = NGRAM) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; with fewer words, one for them all."""
    w = Words(texts, lower=True)
    h, at = w.grams(k)
    doc = w.doc[at]
    sizes = np.bincount(w.doc, minlength=len(texts)) if len(w.doc) else np.zeros(len(texts), int)
    first = np.cumsum(sizes) - sizes
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    extra = np.zeros(len(short), np.uint64)
    for j, d in enumerate(short):
        x = w.hash[first[d] : first[d] + sizes[d]]
        extra[j] = mix(grams(x, np.zeros(len(x), int), len(x))[0] ^ np.uint64(len(x)))[0]
    h, doc = np.concatenate([h, extra]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.zeros(0, bool)
    h, doc = h[fresh], doc[fresh]
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [h[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _united(texts: list) -> list[np.ndarray]:
    """sets, where a document may be a list of texts: its set is the union of theirs."""
    parts = [t if isinstance(t, list) else [t] for t in texts]
    found, out, at = sets([x for t in parts for x in t]), [], 0
    for t in parts:
        few = found[at : at + len(t)]
        out.append(few[0] if len(few) == 1 else np.unique(np.concatenate(few)) if few else np.zeros(0, np.uint64))
        at += len(t)
    return out


def _groups(batches, columns):
    """Lists of rows of at most DOCS documents and about CHUNK bytes of text (the last column)."""
    rows, size = [], 0
    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in columns), strict=True):
            rows.append(row)
            size += sum(map(len, row[-1])) if isinstance(row[-1], list) else len(row[-1] or "")
            if len(rows) == DOCS or size >= CHUNK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _send(docs: DataFrame, keys: list[int]) -> DataFrame:
    def run(batches):
        part = TaskContext.get().partitionId()
        dst = keys[part % len(keys)]
        for k, rows in enumerate(_groups(batches, ["doc_id", "text"])):
            found = _united([t for _, t in rows])
            ids = np.array([i for i, _ in rows], np.int64)
            record = np.zeros(len(rows), _RECORD)
            record["n"] = [len(x) for x in found]
            record["k1"] = [int(mix(x).sum(dtype=np.uint64)) for x in found]
            record["k2"] = [int(np.bitwise_xor.reduce(mix(x * np.uint64(0xA24BAED4963EE407) + np.uint64(1)))) if len(x) else 0 for x in found]
            yield note(ids, record.tobytes(), dst, keys[(part + k) % len(keys)])
            doc = np.repeat(np.arange(len(rows)), record["n"])
            yield from messages(np.concatenate(found), doc, ids, dst, keys)

    return docs.mapInArrow(lean(run), MESSAGE)


ROWS = "doc_id long, n long, k1 long, k2 long, shared binary"


def _rows(answers: DataFrame, n: int) -> DataFrame:
    """A row for each document; shared (low 48 bits, rarest first) only where a link is possible."""
    names = [x.split()[0] for x in ROWS.split(", ")]

    def run(batches):
        ids, low, df, notes = gathered(batches)
        spans = {i: (a, b) for i, a, b in per_document(ids)}
        for docs, meta in notes:
            record, out = np.frombuffer(meta, _RECORD), []
            for i, r in zip(docs.tolist(), record, strict=True):
                a, b = spans.get(i, (0, 0))
                kept = None
                if b - a and 100 * (b - a) >= PERCENT * int(r["n"]):
                    kept = pack48(low[a:b][np.lexsort((low[a:b], df[a:b]))])
                out.append((i, int(r["n"]), int(r["k1"].astype(np.int64)), int(r["k2"].astype(np.int64)), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 4 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))], names=names)

    return answers.repartition(n, "dst").mapInArrow(lean(run), ROWS)


CANDIDATES = "a long, b long, hub long, docs binary"
_CANDIDATES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hub", pa.int64()), ("docs", pa.binary())])
_ENTRY = np.dtype([("doc", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def _needed(nx, ny):
    """The least overlap of linked sets of these sizes: 100 o >= 75 (nx + ny - o)."""
    return -(-(PERCENT * (nx + ny)) // (100 + PERCENT))


def _possible(n, pos, nx, px):
    """Whether sizes and the places of a common column allow a link."""
    return np.minimum(n - pos, nx - px) >= _needed(n, nx)


def _candidates(rows: DataFrame, keys: list[int]) -> DataFrame:
    """Pairs (a, b) to verify, with their hub; and, with null a and b, each hub's column of rows."""
    entries, n = "p int, low binary, entry binary", len(keys)

    def send(batches):
        for b in batches:
            lows, recs = [], []
            for i, size, shared in zip(*(b[c].to_pylist() for c in ("doc_id", "n", "shared")), strict=True):
                h = unpack48(shared)
                before, prefix = size - len(h), size - -(-PERCENT * size // 100) + 1
                h = h[: max(0, prefix - before)]
                rec = np.zeros(len(h), _ENTRY)
                rec["doc"], rec["n"], rec["pos"] = i, size, before + np.arange(len(h))
                lows.append(h)
                recs.append(rec)
            if not lows:
                continue
            h, rec = np.concatenate(lows), np.concatenate(recs)
            out = [(keys[p], pack48(h[at]), rec[at].tobytes()) for p, at in by_part(part_of(mix(h), n), n)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["p", "low", "entry"])

    def pair(batches):
        low, rec = [], []
        for b in batches:
            low.append(b["low"].to_pylist())
            rec.append(b["entry"].to_pylist())
        low, rec = unpack48(b"".join(x for y in low for x in y)), np.frombuffer(b"".join(x for y in rec for x in y), _ENTRY)
        order = np.lexsort((rec["doc"], low))
        low, rec = low[order], rec[order]
        seen, pairs, columns = set(), [], set()
        for s, e in runs(low):
            if e - s < 2:
                continue
            x = rec[s:e]
            # rows that no other row of the column can reach, by size, are out
            most = ((100 + PERCENT) * (x["n"] - x["pos"]).astype(np.int64)) // PERCENT - x["n"]
            for _ in range(2):
                fits = (most >= x["n"].min()) & (x["n"] <= most.max())
                x, most = x[fits], most[fits]
                if len(x) < 2:
                    break
            if len(x) < 2:
                continue
            hub = int(np.argmin(x["pos"] / x["n"]))
            h = x[hub]
            rest = np.delete(x, hub)
            ok = _possible(rest["n"], rest["pos"], h["n"], h["pos"])
            for y in rest["doc"][ok].tolist():
                key = (int(h["doc"]), y)
                if key not in seen:
                    seen.add(key)
                    pairs.append((min(key), max(key), key[0], None))
            for k in np.flatnonzero(~ok):
                others = rest[_possible(rest["n"], rest["pos"], rest["n"][k], rest["pos"][k])]
                for y in others["doc"].tolist():
                    key = (min(int(rest["doc"][k]), y), max(int(rest["doc"][k]), y))
                    if key[0] != key[1] and key not in seen:
                        seen.add(key)
                        pairs.append((*key, None, None))
            if ok.sum() > 1:
                entries = (int(h["doc"]), rest.tobytes())
                if entries not in columns:
                    columns.add(entries)
                    pairs.append((None, None, *entries))
            if len(pairs) >= 4096:
                yield _pairs(pairs)
                pairs = []
        if pairs:
            yield _pairs(pairs)

    return rows.mapInArrow(lean(send), entries).repartition(n, "p").mapInArrow(lean(pair), CANDIDATES)


def _pairs(pairs):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pairs, strict=True), _CANDIDATES, strict=True)], schema=_CANDIDATES)


#: Blocks of columns that a tile of the product is summed over, by the highest bits of their hashes.
BLOCKS = 16
#: Entries of both sides of a tile.
TILE = 1 << 20


def overlaps(sizes: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], blocks: int = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted element of the product, its overlap and the blocks of columns it was summed over.

    left and right hold the shared columns (low 48 bits) of an element's two rows, sizes the rows'
    whole sizes. Block by block of columns the overlaps of all elements are counted at once and
    added up; an element goes as soon as its count and the columns that are left on its shorter side
    cannot reach what its sizes need. Its count is then what it had so far.
    """
    m = len(left)
    needs = _needed(sizes[:, 0], sizes[:, 1])
    count, seen, alive = np.zeros(m, np.int64), np.zeros(m, np.int64), np.ones(m, bool)
    shift = np.uint64(48 - (blocks - 1).bit_length())
    sides, rest = [], []
    for side in (left, right):
        element = np.repeat(np.arange(m, dtype=np.uint64), [len(x) for x in side])
        h = np.concatenate(side) if m else np.zeros(0, np.uint64)
        block = (h >> shift).astype(np.int64)
        order = np.argsort(block, kind="stable")
        ends = np.searchsorted(block[order], np.arange(blocks + 1))
        sides.append(((element[order] << np.uint64(48)) | h[order], ends))
        rest.append(np.array([len(x) for x in side], np.int64))
    for k in range(blocks):
        part = []
        for s, (entries, ends) in enumerate(sides):
            x = entries[ends[k] : ends[k + 1]]
            element = (x >> np.uint64(48)).astype(np.int64)
            part.append(x[alive[element]])
            rest[s] = rest[s] - np.bincount(element, minlength=m)
        both = np.sort(np.concatenate(part))
        twice = both[1:][both[1:] == both[:-1]]
        count += np.bincount((twice >> np.uint64(48)).astype(np.int64), minlength=m)
        seen[alive] = k + 1
        alive &= count + np.minimum(*rest) >= needs
        if not alive.any():
            break
    return count, seen


def _linked(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """a, b, linked for distinct pairs: the wanted elements of the product, in tiles of bounded size.

    A pair's rows come together by two joins, whose hot sides adaptive execution splits; elements
    that lie together make a tile, whatever row they belong to.
    """
    right = rows.select("doc_id", "n", "shared")
    joined = pairs.select("a", "b").join(right.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb")), "b")
    joined = joined.join(right.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa")), "a")

    def run(batches):
        for b in batches:
            na, x, nb, y = (b[c].to_pylist() for c in ("na", "sa", "nb", "sb"))
            got, at = [], 0
            while at < len(x):
                size, end = 0, at
                while end < len(x) and end - at < 1 << 15 and (size < TILE or end == at):
                    size += (len(x[end]) + len(y[end])) // 6
                    end += 1
                sizes = np.array([na[at:end], nb[at:end]], np.int64).T
                count, _ = overlaps(sizes, [unpack48(v) for v in x[at:end]], [unpack48(v) for v in y[at:end]])
                got.append(100 * count >= PERCENT * (sizes.sum(1) - count))
                at = end
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(np.concatenate(got) if got else [], pa.bool_())], names=["a", "b", "linked"])

    return joined.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(lean(run), "a long, b long, linked boolean")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document of docs.

    Null and empty texts, and those of white space alone, have empty sets and are linked with
    nothing, not even each other. Rows that share a key are one document, whose set is the union of
    theirs; rows without one name no document. Texts of fewer than five words have one n-gram, all
    their words; it equals no five-word one. Repeated rows and repeated n-grams count once; an empty
    table gives no rows.
    """
    given = docs.where(column(key).isNotNull()).select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))
    return _components(given.groupBy("doc_id").agg(F.collect_set("text").alias("text")) if repeats(given) else given)


def _components(given: DataFrame) -> DataFrame:
    """jaccard_components of (doc_id, text) with unique ids; text may be an array of texts."""
    spark = given.sparkSession
    n = 2 * partitions(spark)
    keys = part_keys(spark, n)
    rows = stage(_rows(shared_entries(_send(given, keys), n), n))
    # equal sets: one representative each, by two 64-bit sums of mixed hashes and the size
    named = stage(rows.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    # named is written, so that the join reads two plain exchanges, of which Spark can split a large set
    same = stage(rows.select("doc_id", "n", "k1", "k2").join(named, ["n", "k1", "k2"]).where("doc_id <> rep").select("doc_id", "rep"))
    able = rows.where("shared is not null").select("doc_id", "n", "shared").join(same.select("doc_id"), "doc_id", "left_anti")
    able = stage(able)
    release(named)
    found = stage(_candidates(able, keys))
    pairs = found.where("a is not null").groupBy("a", "b").agg(F.max("hub").alias("hub"))
    checked = stage(_linked(pairs, able))
    missed = checked.where("not linked").select("a", "b")
    links = checked.where("linked").select("a", "b")
    spread: list[DataFrame] = []
    if missed.limit(1).count():
        # a row that its hub does not link to may link to others of the column
        columns = found.where("docs is not null").select("hub", "docs")
        lost = missed.select(F.col("a").alias("hub"), F.col("b").alias("doc")).unionByName(missed.select(F.col("b").alias("hub"), F.col("a").alias("doc")))
        more, entries = _residual(columns, lost)
        spread.append(entries)
        more = more.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        links = links.unionByName(_linked(more, able).where("linked").select("a", "b"))
    parts = connected(links)
    release(able, found, checked, *spread)  # the links are written
    top = parts.select(F.col("id").alias("rep"), "component")
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(same, "doc_id", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    return out.join(top, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def _residual(columns: DataFrame, lost: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of each lost row with the others of its hub's columns, where a link is possible; and
    the staged entries that they are read from."""
    hubs = lost.select("hub").distinct()

    def spread(batches):
        base = TaskContext.get().partitionId() << 36
        k = 0
        for b in batches:
            for hub, docs in zip(b["hub"].to_pylist(), b["docs"].to_pylist(), strict=True):
                x = np.frombuffer(docs, _ENTRY)
                k += 1
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), base + k)), pa.array(np.full(len(x), hub)), *(pa.array(x[c].astype(np.int64)) for c in ("doc", "n", "pos"))], names=["column", "hub", "doc", "n", "pos"])

    entries = stage(columns.join(hubs, "hub", "left_semi").mapInArrow(lean(spread), "column long, hub long, doc long, n long, pos long"))
    x = entries.join(lost, ["hub", "doc"]).select("column", F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"))
    both = x.join(entries.select("column", "doc", "n", "pos"), "column").where("x <> doc")
    needs = F.expr(f"ceil({PERCENT} * (n + nx) / {100 + PERCENT}D)")
    both = both.where(F.least(F.col("n") - F.col("pos"), F.col("nx") - F.col("px")) >= needs)
    return both.select(F.least("x", "doc").alias("a"), F.greatest("x", "doc").alias("b")).distinct(), entries


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the first of their component: one row of each group stays.

    Every row is judged by its own text, rows that share an id and rows without one too; the
    first is the one with the smallest id, of those the one with the least text, and rows without
    an id come last. Null and empty texts equal nothing and stay; an empty table stays empty. Columns
    may have any name.
    """
    given, names = numbered(docs)
    key, text = names["doc_id"], names["text"]
    alike = repeats(given, key) or given.where(F.col(key).isNull()).limit(1).count()
    rows, own = (rows_of(given, key, text), ROW) if alike else (given, key)
    with staged_folders() as made:
        parts = _components(rows.select(F.col(own).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    gone = stage(parts.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")))
    for path in made:
        remove(docs.sparkSession, path)
    kept = rows.join(gone, F.col(own).cast("long") == F.col("gone"), "left_anti")
    return kept.select(*given.columns).toDF(*docs.columns)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 2))) AS i, w FROM w WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 75 * (p.n + q.n - o)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""
