"""Small tables with the awkward cases every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra=()):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(4000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", None, "b", 3),
        (5, long, "en", "a", len(long)), (6, long, "en", "a", len(long)), (7, "x " * 60, "fr", None, 120),
        (8, "12 34 !! 日本語 ́e\x1f z", "en", "B", 10), (9, long[500:9000], "fr", "b", 8500), (10, "it's we'll  do   it\n\n", "en", "b", 9), *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """df with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = ["k", "t", "ids", "n", "part", "h", "host", "n_words", "digest", "key", "_w", "seq", "first", "start", "lang_pred", "score"]
    return df.select("*", *[F.lit(x).alias(x) for x in names if x not in df.columns])


class Given:
    """Takes a table's place: keeps the batch function that a step would run in its tasks, to be run here."""

    def select(self, *_):
        return self

    repartition = select

    def mapInArrow(self, run, schema):
        self.run = run
        return self


class Task:
    """Takes TaskContext's place for such a function."""

    @classmethod
    def get(cls):
        return cls

    @staticmethod
    def partitionId():
        return 0
