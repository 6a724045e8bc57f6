"""The pipeline's stages, each against brute force on what its predecessor kept."""

import zlib
from collections import defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_quality_langid_warc import brute as base_rules  # noqa: E402
from tests.llm.test_repeats_ngrams import brute as components  # noqa: E402
from tests.llm.test_tokens_packing_files import library  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [docs]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, held[-1], SF).write.parquet(f"{tmp_path}/{k}")
        held.append(spark.read.parquet(f"{tmp_path}/{k}"))
    for df in held[1:-1]:
        assert df.columns == docs.columns
    rows = [{r["doc_id"]: r for r in df.collect()} for df in held[:-1]]
    assert set(rows[1]) == {i for i, r in rows[0].items() if not base_rules(r["text"])[-1]}
    assert set(rows[2]) <= set(rows[1]) and len(rows[2]) > 0.95 * len(rows[1])
    found = components([(i, r["text"]) for i, r in sorted(rows[2].items())])
    assert set(rows[3]) == {i for i, (_, c) in found.items() if c == i}
    seen: set[bytes] = set()
    for i, r in sorted(rows[3].items()):
        b, gone, new = r["text"].encode(), set(), []
        for j in range(len(b) - 49):
            if b[j : j + 50] in seen:
                gone.update(range(j, j + 50))
            else:
                new.append(b[j : j + 50])
        seen.update(new)
        assert rows[4][i]["text"] == bytes(c for j, c in enumerate(b) if j not in gone).decode("utf-8", "ignore")
    t, pieces = library(), defaultdict(list)
    for r in held[-1].collect():
        pieces[r["doc_id"]].append(r)
    import numpy as np

    for i, r in rows[4].items():
        ids = np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        assert sum(p["length"] for p in pieces[i]) == len(ids)
        assert all(zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for p in pieces[i])


def test_run_of_whole_pipeline(spark, tmp_path):
    """Its rows are those of the stages one after another: the same documents, and of each the same ids in order."""
    found = corpus_pipeline.run(spark, SF).collect()
    assert len(found) > 0
    held = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, held, SF).write.parquet(f"{tmp_path}/{k}")
        held = spark.read.parquet(f"{tmp_path}/{k}")

    def whole(rows):
        out = defaultdict(list)
        for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
            assert r["start"] == len(out[r["doc_id"]])
            out[r["doc_id"]] += r["ids"]
        return out

    assert whole(found) == whole(held.collect())


def test_sequences_come_with_their_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    texts, t = {r["doc_id"]: r["text"] for r in docs.collect()}, library()
    found = defaultdict(list)
    for r in corpus_pipeline.pack(spark, docs, SF).collect():
        assert len(r["ids"]) == r["length"]
        found[r["doc_id"]].append((r["start"], r["ids"]))
    for i, text in texts.items():
        assert [x for _, ids in sorted(found[i]) for x in ids] == [*t.encode(text or "", add_special_tokens=False).ids, 1]
