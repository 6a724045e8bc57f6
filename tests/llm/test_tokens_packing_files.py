"""Token ids, packing and token files against the libraries and brute force."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import huffman, packing
from gridloom.llm.tokens import Encoder
from tests.llm.helpers import DOCS, Given, Task, awkward, with_clashes

FILE = P.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_word_cache_equals_library(text):
    assert Encoder.of(FILE, P.PATTERN).encode([text, None])[0].tolist() == library().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a b<|endoftext|>c d", "<|endoftext|>", "x <|endoftext|> 日本<|endoftext|>", "<|endoftext |> <|endoftext|"])
def test_added_tokens_in_texts_equal_the_plain_call(spark, text):
    ids = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in Encoder.of(FILE, P.PATTERN).encode(["a b", text])][1] == ids
    assert (50256 in ids) == ("<|endoftext|>" in text)
    df = spark.createDataFrame([(1, text, "en", "s", 1)], DOCS)
    pieces = packing.pack_documents(df, FILE, P.PATTERN, with_ids=True).collect()
    assert [x for r in sorted(pieces, key=lambda r: r["start"]) for x in r["ids"]] == [*ids, 1]
    assert huffman.read_corpus(spark, huffman.write_corpus(df, FILE, P.PATTERN), with_ids=True).first()["ids"] == [*ids, 2]


def expected_ids(df, end):
    t = library()
    return {r["doc_id"]: np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [end], "<u4") for r in df.collect()}


def test_packing_places_every_id_once(spark):
    df = awkward(spark)
    rows = packing.pack_documents(with_clashes(df), FILE, P.PATTERN, with_ids=True).collect()
    want, seen, used = expected_ids(df, 1), defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        part = ids[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["ids"] == part.tolist()
        seen[r["doc_id"]].append((r["start"], r["length"]))
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, ids in want.items():
        at = 0
        for start, n in sorted(seen[k]):
            assert start == at
            at += n
        assert at == len(ids)
    padding = 0
    for spans in used.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_a_packing_task_leaves_no_words_behind(spark, monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", Task)
    texts = [f"only{k} here{k}" for k in range(3000)]
    packed = packing.pack_documents(Given(), FILE, P.PATTERN)
    batch = pa.RecordBatch.from_pydict({"k": list(range(3000)), "t": texts})
    assert sum(b.num_rows for b in packed.run([batch])) >= 3000
    assert not Encoder.of(FILE, P.PATTERN).cache


def test_packing_of_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS), FILE, P.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 120), st.integers(0, 120)), max_size=60), st.booleans())
def test_limits_hold_in_every_dimension(sizes, cut):
    placed = defaultdict(list)
    p = packing.Packer(lambda item, skip, n, s, o: placed[s].append((item, skip, n)), tokens=128, segments=5, loss=90, cut=cut, buffer=16)
    items = [(n, min(n, y) if cut else min(n, y, 90)) for n, y in sizes]
    for k, (n, y) in enumerate(items):
        p.add(k, n, y)
    p.close()
    done = defaultdict(int)
    for pieces in placed.values():
        assert sum(n for _, _, n in pieces) <= 128 and len(pieces) <= 5 or cut and sum(n for _, _, n in pieces) <= 128
        assert sum(n * items[k][1] / items[k][0] for k, _, n in pieces) <= 90 + 1e-6
        for k, _, n in pieces:
            done[k] += n
    assert dict(done) == {k: n for k, (n, _) in enumerate(items)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 120), st.integers(0, 120)), max_size=60), st.integers(1, 6))
def test_segment_limit_holds_with_cuts(sizes, segments):
    placed, done = defaultdict(list), defaultdict(int)
    p = packing.Packer(lambda item, skip, n, s, o: placed[s].append((item, skip, n, o)), tokens=128, segments=segments, loss=90, cut=True, buffer=16)
    items = [(n, min(n, y)) for n, y in sizes]
    for k, (n, y) in enumerate(items):
        p.add(k, n, y)
    p.close()
    for pieces in placed.values():
        assert len(pieces) <= segments and sum(n for _, _, n, _ in pieces) <= 128
        assert sum(n * items[k][1] / items[k][0] for k, _, n, _ in pieces) <= 90 + 1e-6
        at = 0
        for k, skip, n, offset in pieces:
            assert (skip, offset) == (done[k], at) or skip > 0
            at, done[k] = at + n, done[k] + n
    assert dict(done) == {k: n for k, (n, _) in enumerate(items)}


def test_pack_examples_keeps_whole_examples(spark):
    df = spark.createDataFrame([("a", 100, 50), ("b", 2000, None), ("c", None, None), ("d", 1900, 0)], "item string, tokens long, loss long")
    rows = packing.pack_examples(df.coalesce(1), "item").collect()
    assert sorted((r["item"], r["tokens"]) for r in rows) == [("a", 100), ("b", 2000), ("d", 1900)]
    with pytest.raises(Exception, match="fits no sequence"):
        packing.pack_examples(spark.createDataFrame([("a", 5000, 1)], "item string, tokens long, loss long"), "item").collect()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=2000), st.integers(6, 18))
def test_codes_are_prefix_free_and_round_trip(ids, limit):
    ids = np.array(ids)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=64), limit)
    assert lengths.max() <= limit and (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
    bits, marks = huffman.encode_block(ids, lengths, huffman.canonical(lengths))
    got = huffman.decode_blocks([(bits, marks, len(ids)), (bits, marks, len(ids))], huffman.lookup(lengths))
    assert got[0].tolist() == ids.tolist() == got[1].tolist()


def test_code_lengths_are_optimal_without_a_limit():
    import heapq

    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    assert (huffman.code_lengths(counts) * counts).sum() == cost


def test_token_files_round_trip(spark):
    df = awkward(spark, [(6, "again", "en", "a", 5)])
    root = huffman.write_corpus(with_clashes(df), FILE, P.PATTERN)
    rows = sorted(huffman.read_corpus(spark, root, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in df.collect())
    want, at = expected_ids(df, 2), 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        if r["doc_id"] != 6:
            assert r["ids"] == want[r["doc_id"]].tolist() and r["ids_crc32"] == zlib.crc32(want[r["doc_id"]].tobytes())
        at += r["n_tokens"]


def test_token_files_of_empty_table(spark):
    assert huffman.read_corpus(spark, huffman.write_corpus(spark.createDataFrame([], DOCS), FILE, P.PATTERN)).count() == 0
