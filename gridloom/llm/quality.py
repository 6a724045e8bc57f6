"""Quality rules with host-level verdicts, in DataFrame functions only.

Base rules judge each document by itself. Failures are then summed by host (the document's
source), each host's failure rate is shrunk towards the corpus by a Beta prior fitted to the
hosts (method of moments, less binomial chance), and hosts whose shrunk rate passes a limit lose all their documents.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import SPACE, column, numbered, stage

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: The prior weighs as many documents as the fit says, within these bounds.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 10_000.0

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def with_base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns in BASE added (existing columns of those names are replaced).

    Null text counts as no words; an empty text has none either. Windows of eight words are
    compared by a 64-bit hash within their own document.
    """
    keep = [c for c in docs.columns if c not in BASE]
    here = [column(c) for c in keep]
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    words = docs.select(
        *here,
        F.array_remove(F.split(body, f"{SPACE}+"), "").alias("_w"),
        (F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    counted = words.select(
        *here,
        "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") > REPEAT_WINDOW, F.transform(F.sequence(F.lit(1), F.size("_w") - (REPEAT_WINDOW - 1)), lambda i: F.xxhash64(F.slice("_w", i, REPEAT_WINDOW)))).alias("_h"),
    )
    marked = counted.withColumn("_twice", F.size(F.array_distinct("_h")) < F.size("_h"))
    ordered = marked.withColumn("_o", F.when(F.col("_twice"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i, d: F.coalesce(F.get("_o", i + d)["h"] == x["h"], F.lit(False))
    # get() with a negative index is null, so the first and last entries need no case of their own
    found = ordered.withColumn("_p", F.sort_array(F.transform(F.filter("_o", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])))
    reach = F.transform("_p", lambda x, j: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get("_p", j + 1) - x, F.lit(REPEAT_WINDOW))))
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)
    out = found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).select(*here, *BASE)


def host_of(source: str = "source") -> Column:
    """The host: the source in lower case; null stays null and has no host verdict."""
    return F.lower(column(source).cast("string"))


def host_verdicts(base: DataFrame, host: str = "host", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk), host_failed: one row for each non-null host.

    Only sums by host are shuffled, so a host with a third of all rows costs no more than any
    other. The prior is one row: its mean is the corpus rate, its weight comes from how far the
    hosts' rates spread beyond that mean, less what chance alone spreads the rates of hosts of
    their sizes: many small hosts that differ by chance only are shrunk as far as the bounds allow.
    No hosts give no rows.
    """
    # written, as the fit and the verdicts read the sums again: base is looked at once
    hosts = stage(base.groupBy(host).agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))).where(F.col(host).isNotNull())
    total = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count("*").alias("k")).first()
    if not total["n"]:
        return hosts.select(host, "n_docs", "n_failed", F.lit(0.0).alias("host_rate"), F.lit(False).alias("host_failed"))
    mean = total["f"] / total["n"]
    chance = F.lit(mean * (1 - mean)) / F.col("n_docs")
    spread = hosts.agg(F.avg(F.pow(F.col("n_failed") / F.col("n_docs") - F.lit(mean), 2) - chance).alias("v")).first()["v"]
    weight = LEAST_WEIGHT if mean in (0.0, 1.0) else min(MOST_WEIGHT, max(LEAST_WEIGHT, mean * (1 - mean) / max(spread, 1e-12) - 1))
    rate = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.select(host, "n_docs", "n_failed", rate.alias("host_rate"), (rate > max_rate).alias("host_failed"))


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """key, host, the base columns and kept, a row for each row of docs.

    kept is false for documents that fail a base rule, else what the host verdict says; a null source
    has none. Null and empty texts have no words and fail; repeated rows are judged alike; an empty
    table gives no rows. The base
    columns are staged once and used twice: for the sums by host and for the join back, whose
    build side Spark broadcasts only while it is below its own size limit; beyond it the join
    shuffles, and adaptive execution splits a host that holds too many rows.
    """
    base = stage(with_base_rules(docs.select(F.col(f"`{key}`").alias(key), host_of(source).alias("host"), F.col(f"`{text}`").alias("text"))).drop("text"))
    # written, so that its size is known: broadcast below Spark's limit, two plain exchanges beyond
    bad = stage(host_verdicts(base, "host", max_rate).where("host_failed").select("host", "host_failed"))
    joined = base.join(bad, "host", "left")
    return joined.select(key, "host", *BASE, (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that quality() keeps. Repeated rows are judged alike;
    null and empty texts fail; a null source has no host verdict; an empty table stays empty. Columns
    may have any name.

    The base rules run twice, once for the sums by host and once for the rows that stay: only the
    hosts that fail are written in between.
    """
    given, names = numbered(docs)
    judged = with_base_rules(given.withColumn("host", host_of(names["source"])), names["text"])
    # written, so that its size is known: rows are not dealt by host, which may hold a third of them,
    # unless the hosts that fail are too many to broadcast; Spark can split a large host even then
    bad = stage(host_verdicts(judged.select("host", "base_failed"), "host").where("host_failed").select("host", F.lit(True).alias("_bad")))
    # a filter would be pushed below the projections, which nests their expressions into one another
    # beyond all measure; a row for each element of an array of one or none selects as well
    passed = judged.withColumn("_passed", F.explode(F.when(~F.col("base_failed"), F.array(F.lit(True)))))
    flags = passed.join(bad, "host", "left").where(F.col("_bad").isNull())
    return flags.select(*given.columns).toDF(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, lower(source) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
c AS (SELECT doc_id, host, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - coalesce(len(list_distinct(ls)), 0) AS n_dup_lines FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, n_words - 6)) AS i FROM c WHERE n_words >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
v AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id),
b AS (SELECT c.doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed FROM c LEFT JOIN v USING (doc_id)),
h AS (SELECT host, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE host IS NOT NULL GROUP BY host),
m AS (SELECT sum(f)::DOUBLE / sum(n) AS m FROM h),
s AS (SELECT avg(pow(f::DOUBLE / n - m, 2) - m * (1 - m) / n) AS v, any_value(m) AS m FROM h, m),
p AS (SELECT m, CASE WHEN m IN (0, 1) THEN 2.0::DOUBLE ELSE least(10000.0::DOUBLE, greatest(2.0::DOUBLE, m * (1 - m) / greatest(v, 1e-12) - 1)) END AS k FROM s),
x AS (SELECT host FROM h, p WHERE (f + m * k) / (n + k) > 0.5)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND (host IS NULL OR host NOT IN (SELECT host FROM x)) AS kept FROM b
"""
