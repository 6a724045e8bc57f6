"""Long words, large vocabularies and weights beyond 64 bits."""

import time

import numpy as np
import pytest

from gridloom.llm import bpe, huffman, maxscore, queries
from tests.llm.test_bpe_maxscore import LIBRARY


def test_a_megabyte_of_one_letter():
    codec = bpe.Codec.of(queries.RANK_FILE, queries.PATTERN)
    for word in ("x" * 20_000, "ab" * 10_000, "=-+" * 7_000):
        assert codec.word(word.encode()) == LIBRARY.encode_ordinary(word)
    began = time.perf_counter()
    ids = codec.word(b"x" * 1_000_000)
    assert time.perf_counter() - began < 5 and codec.decode(ids) == b"x" * 1_000_000 and not codec.large


def test_vocabulary_of_200_000_ids(spark):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 1000, 200_000)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.MAX_BITS and (lengths > 0).sum() == (counts > 0).sum()
    ids = rng.choice(np.flatnonzero(counts), 5000)
    bits, marks = huffman.encode_block(ids, lengths, huffman.canonical(lengths))
    assert np.array_equal(huffman.decode_blocks([(bits, marks, len(ids))], huffman.lookup(lengths))[0], ids)
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    root = huffman.write_corpus(docs, queries.LIBRARY_FILE, queries.PATTERN, end_id=60_000)
    assert [r["ids"][-1] for r in huffman.read_corpus(spark, root, with_ids=True).orderBy("doc_id").collect()] == [60_000] * 2
    with pytest.raises(ValueError, match="end_id"):
        huffman.write_corpus(docs, queries.LIBRARY_FILE, queries.PATTERN, end_id=1 << 20)


def test_weights_beyond_64_bits_are_an_error(spark):
    rows = [(k, [1e18, 2.0]) for k in range(3)]
    v = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="64 bits"):
        maxscore.top_k(v, v, k=1).collect()


def test_floors_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.standard_normal(6)]) for k in range(400)] + [(400 + k, [0.5] * 6) for k in range(60)]
    v = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = v.where("key % 7 = 0")
    got = sorted(map(tuple, maxscore.top_k(v, asked, k=5, shard=64).collect()))
    monkeypatch.setattr(maxscore, "PROBE", 3)  # fewer than k: no floors
    assert got == sorted(map(tuple, maxscore.top_k(v, asked, k=5, shard=64).collect()))
    x = {r["key"]: np.array(r["v"]) for r in v.collect()}
    want = []
    for q in (k for k in x if k % 7 == 0):
        best = sorted((-int(x[q] @ x[k]), k) for k in x if k != q)[:5]
        want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    assert got == sorted(want)
