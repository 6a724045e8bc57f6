"""Periodic runs against brute force, and on awkward tables."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import periodic, queries
from tests.llm.helpers import awkward, with_clashes

SF = "/root/testdata/sf0.001"


def brute(w, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: every period from each place, the smallest of equal stretches."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((i, n, q) for (i, n), q in out.items())


def planted(i, words):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


sequences = st.lists(st.integers(0, 2), max_size=30)
powers = st.builds(lambda x, n, y: (x * n)[:60] + y, st.lists(st.integers(0, 3), min_size=1, max_size=8), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=4))


@settings(max_examples=400, deadline=None)
@given(st.lists(sequences | powers, min_size=1, max_size=4), st.integers(2, 13))
def test_runs_are_those_of_brute_force(docs, least):
    at, want = 0, []
    for d in docs:
        want += [(s + at, n, q) for s, n, q in brute(d, least)]
        at += len(d)
    symbol = np.array([x + 10 * k for k, d in enumerate(docs) for x in d], np.int64)
    assert list(zip(*(x.tolist() for x in periodic.runs(symbol, [len(d) for d in docs], least)), strict=True)) == want


def test_a_long_run_needs_no_work_for_each_level_and_member():
    """200,000 equal words: a level touches what leaves, not the class."""
    start, length, period = periodic.runs(np.zeros(200_000, np.int64), np.array([200_000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [200_000], [1])


def test_whole_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(texts)
    some = 0
    for i, t in texts.items():
        words = planted(i, [w.decode() for w in (t or "").encode().split()])
        if len(words) > 1500:
            continue  # brute force takes too long
        runs = brute(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[i]
        assert (r["n_runs"], r["runs_sha256"], r["collapsed_sha256"]) == (len(runs), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        some += bool(runs)
    assert some >= 10


def test_awkward_tables(spark):
    df = with_clashes(awkward(spark, [(5, "a b " * 9 + "c", "en", "a", 1), (None, "x y z " * 5, None, None, None)]))
    rows = periodic.find_runs(df).collect()
    assert len(rows) == df.count()
    of = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert of[1, 0]["runs"] == [] and of[1, 0]["collapsed"] == "" and of[3, 0]["collapsed"] == ""
    assert [tuple(x) for x in of[7, 60]["runs"]] == [(0, 60, 1)] and of[7, 60]["collapsed"] == "x"
    assert [tuple(x) for x in of[5, 19]["runs"]] == [(0, 18, 2)] and of[5, 19]["collapsed"] == "a b c"
    assert [tuple(x) for x in of[None, 15]["runs"]] == [(0, 15, 3)]
    assert periodic.digest(periodic.find_runs(df.limit(0))).count() == 0 and periodic.with_tails(df).count() == df.count()
