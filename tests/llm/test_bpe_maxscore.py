"""BPE by joins against the library, and MaxScore against brute force."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import bpe, maxscore
from tests.llm.helpers import DOCS, awkward, with_clashes

FILE = P.path("byte_bpe_50k.tiktoken")


def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY, CODEC = library(), bpe.Codec.of(FILE, P.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text("ab \n'", max_size=300) | st.text("aeinrst", min_size=50, max_size=400))
def test_texts_equal_library_and_round_trip(text):
    ids = CODEC.encode_texts([text, None])[0].tolist()
    assert ids == LIBRARY.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200), st.data())
def test_join_is_the_same_at_every_cut(data, draw):
    whole = CODEC.leaf(data) if data else []
    cut = draw.draw(st.integers(0, len(data)))
    assert CODEC.join(CODEC.encode(data[:cut]), CODEC.encode(data[cut:])) == whole == CODEC.encode(data)


def test_every_token_encodes_to_itself():
    rng = random.Random(1)
    for t in rng.sample(sorted(CODEC.ranks), 5000):
        assert CODEC.leaf(t) == [CODEC.ranks[t]]


def test_long_words():
    rng = random.Random(3)
    for text in ("a" * 3000, "".join(rng.choice("etaoinshrdlu") for _ in range(3000)), "=" * 2500 + "ab" * 500):
        assert CODEC.encode_texts([text])[0].tolist() == LIBRARY.encode_ordinary(text)


def test_query_rows(spark):
    df = awkward(spark, [(6, "again", "en", "a", 5)])
    rows = bpe.encode_decode(with_clashes(df), FILE, P.PATTERN).collect()
    want = []
    for r in df.collect():
        ids = np.array(LIBRARY.encode_ordinary(r["text"] or ""), "<u4")
        want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows)) == sorted(want)
    assert bpe.encode_decode(spark.createDataFrame([], DOCS), FILE, P.PATTERN).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, key int, v int"


def brute(rows, k):
    v = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            v.setdefault(i, []).append([int(np.floor(64 * np.float64(np.float32(x)))) for x in e])
    out = []
    for q in v:
        if q % 20 == 0:
            for own in v[q]:
                found = sorted((-sum(a * b for a, b in zip(own, c, strict=False)), i) for i, cs in v.items() if i != q for c in cs)[:k]
                out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def run(df, k, **sizes):
    q = maxscore.quantised(df)
    return sorted(map(tuple, maxscore.top_k(q, q.where("key % 20 = 0"), k, **sizes).collect()))


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=12) * (0.2 if i % 7 else 0.0)], 0, 1, 2) for i in range(700)]
    rows += [(1000 + i, rows[3][1], 0, 1, 2) for i in range(40)]
    rows += [(2000, None, 0, 1, 2), (2020, [None] * 12, 0, 1, 2), (2040, [float("nan")] * 12, 0, 1, 2), (2060, [float("inf")] * 12, 0, 1, 2), (2080, [], 0, 1, 2), (None, rows[1][1], 0, 1, 2)]
    df = spark.createDataFrame(rows, VECTORS)
    assert run(df, 20, shard=256, block=20) == brute(rows, 20)
    assert run(df.where("vec_id < 15"), 20) == brute([r for r in rows if r[0] is not None and r[0] < 15], 20)
    assert run(df.limit(0), 20) == []


def test_tiles_prune_without_loss():
    rng = np.random.default_rng(4)
    x = rng.integers(-30, 30, (9000, 16)) * (rng.random((9000, 16)) < 0.4)
    s = maxscore.Shard(np.arange(9000), list(x))
    for q in (0, 17, 8999):
        keys, scores = s.top(x[q], q, 7)
        full = x @ x[q]
        order = [i for i in np.lexsort((np.arange(9000), -full)) if i != q][:7]
        assert keys.tolist() == order and scores.tolist() == full[order].tolist()


def test_repeated_query_rows_have_lists_of_their_own(spark):
    """Only the own row of a query is left out: others of its key are candidates."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0, 1, 2) for i in range(50)]
    rows += [rows[20], rows[20], (40, rows[3][1], 0, 1, 2), (60, [], 0, 1, 2), (60, [0.0] * 6, 0, 1, 2)]
    v = [(i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in e]) for i, e, *_ in rows]
    want = []
    for at, (q, own) in enumerate(v):
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(own, c, strict=False)), i) for j, (i, c) in enumerate(v) if j != at)[:4]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    df = spark.createDataFrame(rows, VECTORS)
    assert run(df, 4) == run(df, 4, shard=7, block=2) == sorted(want)
