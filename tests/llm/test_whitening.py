"""Whitening against numpy over all rows, and on awkward tables."""

import numpy as np
import pytest

from gridloom.llm import queries, whitening
from tests.llm.helpers import with_clashes

SF = "/root/testdata/sf0.001"


def held(out, k):
    """(vec_ids, n, deviation, whitened matrix, explained, errors) of rows of whiten()."""
    rows = sorted(map(tuple, out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()))
    ids = [r[0] for r in rows[::k]]
    assert [r[1] for r in rows] == list(range(1, k + 1)) * len(ids)
    return ids, {r[2] for r in rows}, [r[3] for r in rows[::k]], np.array([r[4] for r in rows]).reshape(-1, k), np.array([r[5] for r in rows[:k]]), {r[6] for r in rows}


def check(out, ids, vectors, k):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    c = (n * x - total) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = c @ (u / np.sqrt(e))
    got_ids, ns, deviation, w, explained, errors = held(out, k)
    assert got_ids == sorted(ids) and ns == {n}
    order = np.argsort(ids, kind="stable")
    assert deviation == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)) for row in x[order]]
    assert np.allclose(np.abs(w), np.abs(want[order]), atol=1e-8) and np.allclose(np.abs((w * want[order]).mean(0)), 1, atol=1e-9)
    assert np.allclose(explained, e / np.trace(v), rtol=1e-10)
    assert len(errors) == 1 and max(errors) < 1e-9


def table(spark, vectors, ids=None):
    rows = [(int(i), [float(a) for a in v]) for i, v in zip(range(len(vectors)) if ids is None else ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_whole_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(queries.op13_whitening(spark, SF), [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 32)


def test_a_gap_in_the_spectrum_needs_no_expansion(spark):
    """Where eigenvalues fall steeply, the range finder's block is enough; where they are alike, it expands."""
    rng = np.random.default_rng(2)
    steep = rng.standard_normal((500, 8)) @ rng.standard_normal((8, 60)) * 40 + rng.standard_normal((500, 60)) * 1e-3
    flat = rng.standard_normal((500, 60)) * 4
    fits = [whitening.fit(whitening.integers(table(spark, v)), components=k) for v, k in ((steep, 4), (flat, 32))]
    assert (fits[0].full, fits[1].full) == (False, True)
    assert 1 < fits[0].passes <= whitening.PASSES and fits[1].passes < whitening.PASSES
    check(whitening.whiten(table(spark, steep), components=4), range(500), steep, 4)
    check(whitening.whiten(table(spark, flat)), range(500), flat, 32)


def test_awkward_tables(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 5))
    df = table(spark, [*good, good[0]])
    bad = spark.createDataFrame([(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, []), (None, None)], df.schema)
    out = whitening.whiten(with_clashes(df.unionByName(bad)).withColumn("x", whitening.F.lit(1)).withColumn("component", whitening.F.lit(1)))
    check(out, range(41), [*good, good[0]], 5)
    again = whitening.whiten(df.withColumn("vec_id", whitening.F.lit(7)))
    assert again.groupBy("vec_id", "component").count().collect() and again.count() == 41 * 5
    assert whitening.whiten(bad).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 9)).count() == 0
    # a dimension that does not vary has no component
    assert {r["component"] for r in whitening.whiten(table(spark, [[k, 3.0] for k in range(9)])).collect()} == {1}
    assert {r["vec_id"] for r in whitening.whiten(table(spark, [[1.0], [2.0]]).withColumn("vec_id", whitening.F.lit(None).cast("long"))).collect()} == {None}
    with pytest.raises(ValueError, match="several lengths"):
        whitening.whiten(table(spark, [[1.0], [2.0, 3.0]]))
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table(spark, [[1e30], [2.0]]))
    with pytest.raises(Exception, match="beyond 64 bits"):
        whitening.whiten(table(spark, [[1e12]] * 3000 + [[0.0]] * 9000)).count()
