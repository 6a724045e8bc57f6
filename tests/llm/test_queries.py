"""Whole registered queries against the libraries, and every pipeline stage on awkward tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gridloom.llm import bpe, queries
from tests.llm.helpers import awkward, with_clashes
from tests.llm.test_bpe_maxscore import LIBRARY
from tests.llm.test_tokens_packing_files import FILE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(FILE)
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def test_every_document_encodes_as_the_library_would(spark, texts):
    want = []
    for i, t in texts.items():
        x = np.array(LIBRARY.encode_ordinary(t), "<u4")
        want.append((i, len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, queries.op1_bpe_round_trip(spark, SF).collect())) == sorted(want)


def test_words_come_from_joins(texts, monkeypatch):
    """Every word that is no token is a join of its halves."""
    codec, joined = bpe.Codec(queries.RANK_FILE, queries.PATTERN), []
    join = codec.join
    monkeypatch.setattr(codec, "join", lambda a, b: joined.append(1) or join(a, b))
    words = {w.encode() for t in texts.values() for w in codec.split_any(t)}
    long = [w for w in words if w not in codec.ranks]
    for w in long:
        before = len(joined)
        codec.pieces.clear()
        assert len(codec.encode(w)) > 1 and len(joined) > before
    assert len(long) > 1000


def test_every_document_is_packed_whole(spark, ids):
    placed, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op2_vector_packing(spark, SF).collect():
        x = np.array([*ids[r["doc_id"]], 1], "<u4")
        assert r["doc_tokens"] == len(x) and r["ids_crc32"] == zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes())
        placed[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(placed) == set(ids)
    for i, spans in placed.items():
        assert [s for s, _ in sorted(spans)] == np.cumsum([0, *[n for _, n in sorted(spans)]])[:-1].tolist() and sum(n for _, n in spans) == len(ids[i]) + 1
    padding = total = 0
    for spans in sequences.values():
        assert [s for s, _ in sorted(spans)] == np.cumsum([0, *[n for _, n in sorted(spans)]])[:-1].tolist()
        n = sum(n for _, n in spans)
        assert n <= 2048
        total, padding = total + n, padding + (0 if n & (n - 1) == 0 else 2048 - n)
    assert padding <= 0.01 * total


def test_every_document_is_read_back_from_its_file(spark, ids):
    at, want = 0, []
    for i in sorted(ids):
        x = np.array([*ids[i], 2], "<u4")
        want.append((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert sorted(map(tuple, queries.op8_token_files(spark, SF).collect())) == want


@pytest.mark.parametrize("rows", ["awkward", "repeated", "empty"])
def test_stages_on_awkward_tables(spark, rows, tmp_path):
    """Clashing columns, nulls, empty and long texts, repeated rows, and no rows at all."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    df = with_clashes(awkward(spark, [(6, "again " * 30, "en", "a", 5), (None, "no id " * 40, "en", "a", 5), (None, None, None, None, None)] * (2 if rows == "repeated" else 1)))
    df = df.limit(0) if rows == "empty" else df
    held = df
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, held, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.schema(out.schema).parquet(f"{tmp_path}/{k}")
        assert rows != "empty" or out.count() == 0
        if name != "pack":
            assert out.dtypes == df.dtypes and out.count() <= held.count()
            held = out
        else:
            assert out.select("doc_id").distinct().count() == held.select("doc_id").distinct().count()
    # stages that get what the first leaves out
    for name, step in corpus_pipeline.STAGES[2:4]:
        out = step(spark, df, SF)
        assert out.dtypes == df.dtypes, name
        if name == "repeated_spans":
            assert out.count() == df.count()

