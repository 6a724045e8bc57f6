"""Substring dedup by words and by bytes: what is left of each document, and what went.

``by_words`` finds repeated windows with prefix-partitioned suffix trees (see subtrees),
``by_bytes`` with merged Burrows-Wheeler transforms (see bwt); repeats brings the candidates
together and brings the ranges back.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.llm import bwt, subtrees
from gridloom.llm.common import few, lean, numbered
from gridloom.llm.repeats import Kind, bytes_of, lost_ranges, words_of

WORDS = Kind(13, 5, words_of, subtrees.window_classes, sharded=False)
BYTES = Kind(50, 24, bytes_of, bwt.window_classes, sharded=True)


def _ranges(start, until) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(start, np.int64), np.frombuffer(until, np.int64)) if start is not None else (np.zeros(0, np.int64),) * 2


def _apply(docs: DataFrame, kind: Kind, cut, with_text: bool) -> DataFrame:
    """cut(data, spans or None for all) gives kept bytes, symbols and removed symbols."""
    names = ["doc_id", "n", "n_removed", "n_spans", "kept_sha256"] + (["kept"] if with_text else [])
    types = [pa.int64()] * 4 + [pa.string()] + ([pa.string()] if with_text else [])

    def run(batches):
        for b in few(batches):
            rows = []
            for i, text, copy, start, until in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "copy", "start", "until")), strict=True):
                kept, n, removed, spans = cut((text or "").encode("utf-8", "surrogatepass"), copy, *_ranges(start, until), kind.width)
                rows.append((i, n, removed, spans, hashlib.sha256(kept).hexdigest(), *([kept.decode("utf-8", "ignore")] if with_text else [])))
                if len(rows) == 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(lean(run), "doc_id long, n long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else ""))


def _cut_words(data, copy, start, until, width):
    words = data.split()
    n = len(words)
    if copy and n >= width:
        return b"", n, n, 1
    if not len(start):
        return b" ".join(words), n, 0, 0
    kept, at = [], 0
    for a, b in zip(start.tolist(), until.tolist(), strict=True):
        kept += words[at:a]
        at = b
    return b" ".join(kept + words[at:]), n, int((until - start).sum()), len(start)


def _cut_bytes(data, copy, start, until, width):
    n = len(data)
    if copy and n >= width:
        return b"", n, n, 1
    kept, at = [], 0
    for a, b in zip(start.tolist(), until.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), n, int((until - start).sum()), len(start)


def by_words(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n, n_removed, n_spans, kept_sha256 (and kept as text) by windows of 13 words.

    n counts words. Words are split at ASCII white space and compared as they are; the kept ones
    are joined by one space. Null and empty texts have no words; texts of fewer words than a window
    lose none. Rows without an id have no row here; rows that share one each have theirs, and lose
    nothing to each other; an empty table gives none.
    """
    return _apply(lost_ranges(docs, WORDS), WORDS, _cut_words, with_text)


def by_bytes(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n, n_removed, n_spans, kept_sha256 (and kept as text) by windows of 50 bytes.

    n counts bytes of UTF-8. Null text is empty; texts shorter than a window lose nothing. Rows
    without an id have no row here; rows that share one each have theirs, and lose nothing to each
    other; an empty table gives none.
    """
    return _apply(lost_ranges(docs, BYTES), BYTES, _cut_bytes, with_text)


def cut_documents(docs: DataFrame) -> DataFrame:
    """docs with its columns and rows, repeated spans of 50 bytes cut from text.

    A character of which only some bytes remain is dropped. n_chars, where there is one, counts
    what is left. Rows without a key, and null and empty texts, stay as they are; of rows that share
    a key, each loses what documents with smaller ids have of its own text. Columns may have any
    name. An empty table stays empty.
    """
    given, names = numbered(docs)
    key, text, chars = names["doc_id"], names["text"], names.get("n_chars")
    others = [c for c in given.columns if c != text]
    found = lost_ranges(given, BYTES, key, text, carried=tuple(others))
    place = {c: f"c{k}" for k, c in enumerate(others)} | {text: "text"}
    out = [place[c] for c in given.columns]

    def run(batches):
        for b in few(batches):
            columns = {c: b[c] for c in out}
            texts = b["text"].to_pylist()
            counts = columns[place[chars]].to_pylist() if chars else None
            for r, (copy, start, until) in enumerate(zip(*(b[c].to_pylist() for c in ("copy", "start", "until")), strict=True)):
                if texts[r] is not None and (copy or start is not None):
                    kept, _, removed, _ = _cut_bytes(texts[r].encode("utf-8", "surrogatepass"), copy, *_ranges(start, until), BYTES.width)
                    if removed:
                        texts[r] = kept.decode("utf-8", "ignore")
                        if counts is not None:
                            counts[r] = len(texts[r])
            columns["text"] = pa.array(texts, columns["text"].type)
            if counts is not None:
                columns[place[chars]] = pa.array(counts, columns[place[chars]].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=out)

    schema = StructType([StructField(place[c], StringType() if c == text else given.schema[c].dataType) for c in given.columns])
    # the key goes along, though nothing reads it: else the texts would be exchanged once more without it
    cut = found.select("doc_id", *out, "copy", "start", "until").mapInArrow(lean(run), schema)
    cut = cut.select(*[F.col(place[c]).cast(given.schema[c].dataType) for c in given.columns])
    return cut.union(given.where(F.col(key).isNull())).toDF(*docs.columns)


ORACLE_WORDS = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS f FROM g),
r AS (SELECT DISTINCT doc_id, i + k AS p FROM m, range(13) t(k) WHERE f < doc_id),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
e AS (SELECT k.doc_id, count(*) AS n, count(r.p) AS gone, string_agg(word, ' ' ORDER BY k.p) FILTER (WHERE r.p IS NULL) AS kept
      FROM k LEFT JOIN r ON r.doc_id = k.doc_id AND r.p = k.p GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN e ON e.doc_id = d.doc_id
"""

ORACLE_BYTES = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, length(hex(coalesce(text, ''))) // 2 AS n FROM documents),
g AS (SELECT doc_id, unnest(range(1, n - 48)) AS i, unnest(list_transform(range(1, n - 48), lambda i: h[2 * i - 1:2 * i + 98])) AS s FROM d WHERE n >= 50),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS f FROM g) WHERE f < doc_id),
o AS (SELECT doc_id, i, lag(i) OVER w AS p FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
q AS (SELECT doc_id, i, count(*) FILTER (WHERE p IS NULL OR p + 50 < i) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM o),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM q GROUP BY 1, 2),
u AS (SELECT doc_id, a, b, lag(b, 1, 1) OVER w AS from_, k FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
e AS (SELECT doc_id, count(*) AS s, sum(b - a) AS gone, string_agg(d.h[2 * from_ - 1:2 * (a - 1)], '' ORDER BY a) AS kept, max(b) AS last FROM u JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN s IS NULL THEN h ELSE concat(kept, h[2 * last - 1:]) END)) AS kept_sha256 FROM d LEFT JOIN e ON e.doc_id = d.doc_id
"""
