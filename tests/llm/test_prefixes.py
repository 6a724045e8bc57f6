"""The registered substring query forms prefix groups and lengthens prefixes."""

import os

from gridloom.llm import queries, repeats, subtrees, substrings

SF = "/root/testdata/sf0.1"


def test_prefixes_are_lengthened_in_the_query(spark, tmp_path):
    seen = str(tmp_path)

    def counting(strings, width):
        words, sizes = subtrees.numbered(strings)
        starts, _ = subtrees._window_starts(sizes, width)
        import numpy as np

        long = int((np.bincount(words[starts]) > subtrees.LIMIT).sum()) if len(starts) else 0
        groups = [len(g) for g in subtrees.prefix_groups(words, starts, width)]
        with open(f"{seen}/{os.getpid()}-{len(strings)}-{len(starts)}", "w") as f:
            f.write(f"{len(groups)} {long} {max(groups, default=0)}")
        return subtrees.window_classes(strings, width)

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kind = repeats.Kind(13, 5, repeats.words_of, counting, sharded=False)
    got = repeats.lost_ranges(docs, kind).select("doc_id", "copy", "start", "until")
    want = repeats.lost_ranges(docs, substrings.WORDS).select("doc_id", "copy", "start", "until")
    plain = lambda df: sorted((r[0], r[1], bytes(r[2] or b""), bytes(r[3] or b"")) for r in df.collect())
    assert plain(got) == plain(want)
    counts = [tuple(map(int, open(f"{seen}/{f}").read().split())) for f in os.listdir(seen)]
    assert sum(c[0] for c in counts) > 4 * len(counts) and sum(c[1] for c in counts) > 0
    assert queries.op5_suffix_tree_dedup.__name__ in queries.QUERIES
