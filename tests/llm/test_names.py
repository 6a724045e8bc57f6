"""Columns of any name through every stage, and pipelines side by side."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, langid, ngrams, substrings
from tests.llm.helpers import awkward

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"
NAMES = ["__row", "_gone", "gone", "_bad", "_passed", "host", "owner", "copy", "c0", "c1", "_t", "k", "k`q", "a b", "x.y", "doc_id2"]


def odd(df):
    """df with columns of names that stages use themselves, and structs whose fields have odd names."""
    pair = F.struct(F.lit(1).alias("a b"), F.struct(F.lit("x").alias("c:d")).alias("e`f"), F.array(F.lit(2.5)).alias("<g>"))
    return df.select("*", *[F.lit(7 + k).alias(n) for k, n in enumerate(NAMES)], pair.alias("odd struct"), F.create_map(F.lit("m"), pair).alias("odd map"))


def tables(spark):
    rows = [(k, f"the quick brown fox number {k} jumps over a lazy dog and runs on " + " ".join(f"word{k}of{j}" for j in range(60)), "en", "a", 9) for k in range(30, 60)]
    plain = awkward(spark, rows + [(k + 100, t, lang, s, n) for k, t, lang, s, n in rows[:5]])
    return {"unique ids": plain, "repeated ids": plain.unionByName(plain.where("doc_id > 40"))}


@pytest.mark.parametrize("ids", ["unique ids", "repeated ids"])
@pytest.mark.parametrize("at", range(4))
def test_columns_come_back_unchanged(spark, ids, at, tmp_path):
    df = odd(tables(spark)[ids])
    name, step = corpus_pipeline.STAGES[at]
    out = step(spark, df, SF)
    assert out.schema.simpleString() == df.schema.simpleString() and out.columns == df.columns
    rows = out.collect()
    assert rows or name == "language_id"
    for r in rows:
        assert [r[len(tables(spark)[ids].columns) + k] for k in range(len(NAMES))] == [7 + k for k in range(len(NAMES))]
        assert r["odd struct"][0] == 1 and r["odd struct"][1][0] == "x" and r["odd map"]["m"][2] == [2.5]


def test_two_pipelines_do_not_know_of_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    made = [[step(spark, d, SF) for d in (first, second)] for _, step in corpus_pipeline.STAGES[:4]]
    for a, b in made:  # what the first call gave can be read after the second, more than once
        assert 0 < a.count() <= first.count() and 0 < b.count() <= second.count() and a.count() == a.count()


def test_whole_pipelines_in_threads(spark):
    got, errors = {}, []

    def run(k):
        try:
            got[k] = sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and got[0] == got[1] and len(got[0]) > 100


def test_staged_folders_are_a_threads_own(spark):
    with common.staged_folders() as mine:
        t = threading.Thread(target=lambda: common.stage(spark.range(1)))
        t.start()
        t.join()
        common.stage(spark.range(1))
    assert len(mine) == 1


def test_a_stage_leaves_no_copy_of_the_documents(spark):
    """Only ids and hosts stay below the shared folder for its reader."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for step in (corpus_pipeline.quality_rules, corpus_pipeline.near_duplicates):
        out = step(spark, docs, SF)
        staged = {f.rpartition("/")[0] for f in out.inputFiles() if "gridloom-" in f}
        assert all("text" not in spark.read.parquet(d).columns and spark.read.parquet(d).count() <= docs.count() for d in staged)


def test_every_language_is_learned(spark):
    """300 languages of letters of their own: none is left out, and the model doesn't grow with them."""
    rng = random.Random(2)
    rows = []
    for k in range(300):
        letters = [chr(0x4E00 + 20 * k + j) for j in range(20)]
        for d in range(8):
            rows.append((len(rows), " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(30)), f"l{k:03d}", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    model = langid.fit(docs)
    assert len(model.langs) == 300 and model.table.shape == (langid.BUCKETS, langid.DIM + 1)
    with pytest.raises(ValueError, match="no languages"):
        langid.fit(docs, most=200)


def test_jaccard_and_ranges_with_odd_keys(spark):
    df = tables(spark)["unique ids"].withColumnRenamed("doc_id", "a b").withColumnRenamed("text", "x.y")
    assert ngrams.jaccard_components(df, "a b", "x.y").count() == df.count()
    assert substrings.lost_ranges(df, substrings.BYTES, "a b", "x.y").count() == df.count()
