"""Conversations packed under three limits at once, against the library's token counts."""

from collections import defaultdict

from gridloom.llm import packing, queries
from tests.llm.test_tokens_packing_files import FILE

SF = "/root/testdata/sf0.001"


def wanted(rows):
    from tokenizers import Tokenizer

    library, sizes = Tokenizer.from_file(FILE), defaultdict(lambda: [0, 0])
    for r in rows:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        sizes[r["conv_id"]][0] += n
        sizes[r["conv_id"]][1] += n if r["role"] == "assistant" else 0
    return {k: tuple(v) for k, v in sizes.items()}


def test_whole_query_and_each_limit_counts(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    sizes = wanted(turns.collect())
    assert {r[0]: tuple(r)[1:] for r in packing.conversation_sizes(turns, queries.LIBRARY_FILE, queries.PATTERN).collect()} == sizes
    rows = queries.conversation_packing(spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["conv_id"]].append((r["skip"], r["tokens"]))
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(sizes)
    for k, spans in pieces.items():
        at = 0
        for skip, n in sorted(spans):
            assert skip == at
            at += n
        assert at == sizes[k][0]
    full = [0, 0, 0]
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["tokens"]
        loss = sum(r["tokens"] * sizes[r["conv_id"]][1] / sizes[r["conv_id"]][0] for r in held)
        assert at <= 8192 and len(held) <= 6 and loss <= 4096 + 1e-6
        full = [full[0] + (at > 8100), full[1] + (len(held) == 6), full[2] + (loss > 4000)]
    assert full[1] and full[2], full
    # without one of the limits the packing is another one
    places = lambda **free: sorted(map(tuple, packing.pack_conversations(turns, queries.LIBRARY_FILE, queries.PATTERN, **free).collect()))
    now = sorted(map(tuple, rows))
    assert places(max_segments=10**6) != now and places(max_loss=10**9) != now and places(max_tokens=10**9) != now


def test_awkward_conversations(spark):
    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", None), (None, 0, None, ""), (None, 1, "assistant", "yes " * 50), (2, 0, "assistant", "word " * 20000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in packing.conversation_sizes(turns, queries.LIBRARY_FILE, queries.PATTERN).collect()}
    assert got[1]["loss"] == 1 and got[None]["tokens"] == got[None]["loss"] + 1 and got[2]["loss"] == got[2]["tokens"] > 8192
    assert sum(r["tokens"] for r in packing.pack_conversations(turns, queries.LIBRARY_FILE, queries.PATTERN).collect()) == sum(r["tokens"] for r in got.values())
    assert packing.pack_conversations(turns.limit(0), queries.LIBRARY_FILE, queries.PATTERN).count() == 0
