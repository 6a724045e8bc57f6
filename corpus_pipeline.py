"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes all that its predecessor kept and writes Parquet for its successor; all but the
last return the columns of documents, whatever their names, and an empty table where they get one.

What a stage's rows still read below the shared folder is small (hosts, ids of documents that went, or copies;
the documents themselves only where their ids repeat) and stays as long as its caller wants; run()
removes it once the rows are written.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import langid, ngrams, packing, quality, substrings
from gridloom.llm.common import read, release, remove, stage, staged_folders


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or whose host does, go: null and empty texts among them.
    Repeated rows are judged alike."""
    return quality.kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't recognised go, and those without a letter; where no label teaches
    any language, those with a letter stay."""
    return langid.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest id, of those the one with
    the least text; rows without an id come last. Null and empty texts equal nothing and stay."""
    return ngrams.kept_documents(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of 50 bytes that a document with a smaller id has are cut. No row goes; rows without an id,
    and null and short texts, stay as they are."""
    return substrings.cut_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences: each piece with its token ids. Null and empty
    texts are their end id alone; every row is a document of its own."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("pack", pack),
]

#: Language identification and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: a row a piece of each document that the others keep. Nulls, repeated rows and
    ids, and columns of any name are treated as each stage says; an empty table gives no rows.

    Each stage's rows are written and read again as the next one's documents. What it read on its way
    is removed then, and its own rows once its successor's are written.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for _, step in STAGES[:-1]:
        with staged_folders() as made:
            kept = step(spark, docs, sf_dir)
        docs = stage(kept)
        for path in made:
            remove(spark, path)
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
