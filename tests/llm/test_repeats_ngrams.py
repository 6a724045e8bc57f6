"""Substring dedup, the Jaccard join and components against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import bwt, components, ngrams, repeats, subtrees, substrings
from tests.llm.helpers import DOCS, Given, awkward, with_clashes


def same(classes):
    first: dict[int, int] = {}
    return [first.setdefault(int(c), len(first)) for a in classes for c in a]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text("ab\0", max_size=40), min_size=1, max_size=8), st.sampled_from([1, 3, 4, 5, 7, 10, 20]), st.sampled_from([1, 2, 4]))
def test_merged_transforms_tell_equal_windows(texts, width, shards):
    strings = [t.encode() for t in texts]
    want = same([[hash(s[i : i + width]) for i in range(len(s) - width + 1)] for s in strings])
    assert same(bwt.window_classes(strings, width, shards)) == want


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"cc"]), max_size=30), min_size=1, max_size=8), st.sampled_from([1, 2, 5, 13]), st.sampled_from([1, 3, 1000]))
def test_subtrees_tell_equal_windows(docs, width, limit):
    words, sizes = subtrees.numbered([b" ".join(d) for d in docs])
    starts = np.concatenate([np.arange(f, f + max(0, n - width + 1)) for f, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True)]).astype(int)
    want = same([[hash(tuple(words[s : s + width].tolist())) for s in starts]])
    assert same([subtrees.equal_suffixes(words, starts, width, limit)]) == want


def planted(rng, n=70):
    words = ["to", "of", "la", "Été", "x1", "gamma", "delta", "räd", "zeta", "eta9"]
    text = lambda k: " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(k))
    shared = [text(60) for _ in range(3)]
    rows = []
    for i in range(n):
        t = text(rng.randrange(0, 90))
        if i % 3 == 0:
            t += "\n" + rng.choice(shared) + " " + text(rng.randrange(0, 9))
        if i % 11 == 5:
            t = rows[-1][1] or ""
        if i % 13 == 7 and rows[-2][1]:
            w = rows[-2][1].split(" ")
            w[len(w) // 2] = "edited"
            t = " ".join(w)
        rows.append((i * 3, t, "en", "s", 1))
    return rows


def expected(docs, symbols, width, join):
    seen, out = set(), {}
    for i, t in docs:
        x = symbols(t)
        gone, new = [False] * len(x), []
        for j in range(len(x) - width + 1):
            key = tuple(x[j : j + width])
            if key in seen:
                gone[j : j + width] = [True] * width
            else:
                new.append(key)
        seen.update(new)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out[i] = (len(x), sum(gone), spans, hashlib.sha256(join([a for a, g in zip(x, gone, strict=True) if not g])).hexdigest())
    return out


@pytest.mark.parametrize("rows", ["awkward", "planted"])
def test_dedup_by_bytes_and_words(spark, rows):
    df = with_clashes(awkward(spark) if rows == "awkward" else spark.createDataFrame(planted(random.Random(4)), DOCS))
    docs = sorted((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["n"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.by_bytes(df).collect()}
    assert got == expected(docs, lambda t: list(t.encode()), 50, bytes)
    got = {r["doc_id"]: (r["n"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.by_words(df).collect()}
    want = expected(docs, lambda t: t.encode().split(), 13, b" ".join)
    assert {k: v[:2] + v[3:] for k, v in got.items()} == {k: v[:2] + v[3:] for k, v in want.items()}


def test_dedup_of_repeated_rows_and_empty_tables(spark):
    long = "word " * 5 + "a b c d e f g h i j k l m n o p q r s t u v w x y z and more words to come"
    df = spark.createDataFrame([(1, long, "en", "s", 1), (1, long, "en", "s", 1), (2, long, "en", "s", 1), (None, long, "en", "s", 1)], DOCS)
    rows = {r["doc_id"]: r["n_removed"] for r in substrings.by_bytes(df).collect()}
    assert rows == {1: 0, 2: len(long)}
    cut = substrings.cut_documents(df)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in cut.collect()) == [(0, long), (1, long), (1, long), (2, "")] and cut.columns == df.columns
    empty = spark.createDataFrame([], DOCS)
    assert substrings.by_bytes(empty).count() == substrings.by_words(empty).count() == substrings.cut_documents(empty).count() == 0


def test_cut_documents_with_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    rows = planted(random.Random(6))
    names = ["copy", "start", "until", "_id", "low", "owner", "c0", "c1", "digest", "first", "copies", "key", "a b", "a.b"]
    df = spark.createDataFrame(rows + [(None, rows[0][1], "en", "s", 1)], DOCS)
    wide = df.select("text", *[F.lit(i).alias(n) for i, n in enumerate(names)], *[c for c in df.columns if c != "text"])
    plain = sorted((r["doc_id"] or -1, r["text"], r["n_chars"]) for r in substrings.cut_documents(df).collect())
    cut = substrings.cut_documents(wide)
    assert cut.dtypes == wide.dtypes and sorted((r["doc_id"] or -1, r["text"], r["n_chars"]) for r in cut.collect()) == plain
    assert all(r[n] == i for r in cut.collect() for i, n in enumerate(names))


def test_a_part_takes_a_few_bytes_a_window():
    """Of 3 MB of strings that two documents have, the second loses all; what is as long as windows is made piece by piece."""
    rng, n = np.random.default_rng(3), 40_000
    sizes, grams = np.full(n, 76, "<u4"), np.arange(n, dtype="<u4")
    row = {"p": 0, "owner": None, "doc": bytes(n), "start": (100 * np.arange(n)).astype("<u4").tobytes(), "which": np.arange(n).astype("<u2").tobytes(), "size": sizes.tobytes(), "gram": grams.tobytes(), "body": rng.bytes(76 * n)}
    batch = pa.RecordBatch.from_pylist([row | {"dst": k, "ids": np.array([k], "<i8").tobytes()} for k in (1, 2)], pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.binary()) for c in repeats.STRINGS.split(", ")]))
    judged = repeats._judge(Given(), substrings.BYTES, 1)
    tracemalloc.start()
    try:
        out = [r for b in judged.run([batch]) for r in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert {r["dst"] for r in out} == {2}
    found = [np.concatenate([np.frombuffer(r[c], np.int64) for r in out]) for c in ("ids", "start", "until")]
    assert set(found[0].tolist()) == {2}
    assert found[1].tolist() == list(range(0, 100 * n, 100)) and (found[2] - found[1] == 76).all()
    assert peak < 50e6


def test_texts_are_exchanged_once(spark):
    """All steps of the cut read one exchange of the texts."""
    df = spark.createDataFrame(planted(random.Random(6)), DOCS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan then shows what is used again before it runs
    try:
        plans = [f(df)._jdf.queryExecution().executedPlan().toString() for f in (substrings.cut_documents, substrings.by_words, substrings.by_bytes)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for plan in plans:
        dealt = [x for x in plan.split("\n") if "Exchange hashpartitioning(doc_id" in x and "REPARTITION_BY_NUM" in x]
        assert len([x for x in dealt if "ReusedExchange" not in x]) == 1 and len(dealt) == 3


def sharing_ids(rng):
    """Rows of which many share an id with other texts, some repeat one, and some have none."""
    rows = [r for r in planted(rng) if r[1]]
    rows = [(r[0] // 12, *r[1:]) for r in rows]
    return rows + rows[3:9]


def by_row(rows, symbols, width, join):
    """What each row loses to rows with smaller ids, by a pass over ids in order."""
    seen, out = set(), []
    for i in sorted({r[0] for r in rows}):
        new = []
        for t in [r[1] for r in rows if r[0] == i]:
            x = symbols(t)
            gone = [False] * len(x)
            for j in range(len(x) - width + 1):
                new.append(tuple(x[j : j + width]))
                if new[-1] in seen:
                    gone[j : j + width] = [True] * width
            kept = join([a for a, g in zip(x, gone, strict=True) if not g])
            out.append((i, len(x), sum(gone), hashlib.sha256(kept).hexdigest(), kept))
        seen.update(new)
    return sorted(out)


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    rows = sharing_ids(random.Random(8))
    df = spark.createDataFrame(rows + [(None, rows[0][1], "en", "s", 1)], DOCS)
    want = by_row(rows, lambda t: list(t.encode()), 50, bytes)
    assert sorted((r["doc_id"], r["n"], r["n_removed"], r["kept_sha256"]) for r in substrings.by_bytes(df).collect()) == [x[:4] for x in want]
    cut = substrings.cut_documents(df)
    texts = [(i, k.decode("utf-8", "ignore")) for i, *_, k in want] + [(-1, rows[0][1])]
    assert cut.columns == df.columns and sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in cut.collect()) == sorted(texts)
    want = by_row(rows, lambda t: t.encode().split(), 13, b" ".join)
    assert sorted((r["doc_id"], r["n"], r["n_removed"], r["kept_sha256"]) for r in substrings.by_words(df).collect()) == [x[:4] for x in want]


def test_near_duplicates_among_rows_that_share_an_id(spark):
    import duckdb

    a, b, c, d = (" ".join(f"{x}{j}" for j in range(40)) for x in "abcd")
    rows = [(1, a), (2, a + " z"), (2, b), (3, None), (3, c), (4, c), (4, c), (None, b + " y"), (None, d), (5, "two words"), (5, "")]
    df = with_clashes(spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS))
    kept = ngrams.kept_documents(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(1, a), (2, b), (3, ""), (3, c), (0, d), (5, "two words"), (5, "")])
    got = sorted(tuple(r) for r in ngrams.jaccard_components(df).collect())
    documents = duckdb.connect()
    documents.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    documents.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == sorted(documents.execute(ngrams.ORACLE).fetchall())


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return {i: (len(sets[i]), comp[i]) for i in sets}


def near(rng):
    """Chains, stars and templates: rows of one column that link to its hub, to each other, or not at all."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = [(500, " ".join(base), "en", "s", 1)]
    for i in range(25):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w), "en", "s", 1))
    chain = list(base)
    for i in range(12):
        chain = [*chain[3:], *[f"c{i}{j}" for j in range(3)]]
        rows.append((1000 - i, " ".join(chain).upper(), "en", "s", 1))
    template = [f"t{j}" for j in range(40)]
    rows += [(2000 + i, " ".join(template + [f"u{i}{j}" for j in range(k)]), "en", "s", 1) for i in range(30) for k in [rng.randrange(0, 14)]]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = near(rng) + [(5000 + r[0], *r[1:]) for r in planted(rng)]
    df = with_clashes(spark.createDataFrame(rows, DOCS))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngrams.jaccard_components(df).collect()}
    assert got == brute([(r[0], r[1]) for r in rows])
    kept = {r["doc_id"] for r in ngrams.kept_documents(df).collect()}
    assert kept == {i for i, (_, c) in got.items() if c == i}


def test_components_of_awkward_rows(spark):
    df = awkward(spark, [(20, "One", "en", "s", 1), (21, "a b", None, None, 1), (22, "A  b ", None, None, 1), (22, "A  b ", None, None, 1)])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngrams.jaccard_components(df).collect()}
    assert got == brute(sorted({(r["doc_id"], r["text"]) for r in df.collect()}))
    empty = spark.createDataFrame([], DOCS)
    assert ngrams.jaccard_components(empty).count() == 0 and ngrams.kept_documents(empty).count() == 0


def test_connected_components_of_paths_and_cliques(spark):
    rng = random.Random(9)
    path = list(range(100, 160))
    rng.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(1, 2), (2, 3), (1, 3), (7, 7), (9, 8)]
    got = {r["id"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 160), 100), 1: 1, 2: 1, 3: 1, 8: 8, 9: 8}
