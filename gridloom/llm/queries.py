"""The thin queries: each applies one operator to its whole table and derives the contract's columns."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import bpe, huffman, langid, maxscore, ngrams, packing, periodic, quality, substrings, tagpaths, warc, whitening
from gridloom.llm.common import read

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY_FILE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text to ids and back. Nulls, ties and empty tables: see bpe.encode_decode."""
    return bpe.encode_decode(read(spark, sf_dir, "documents"), RANK_FILE, PATTERN)


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed. Nulls, repeated rows and empty tables: see packing.pack_documents."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), LIBRARY_FILE, PATTERN, end_id=1)


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, packed by tokens, count and loss: the packer of op2 where each limit can bind."""
    return packing.pack_conversations(read(spark, sf_dir, "conversations"), LIBRARY_FILE, PATTERN)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and its component. Empty sets, repeated ids and empty tables: see ngrams.jaccard_components."""
    return ngrams.jaccard_components(read(spark, sf_dir, "documents"))


def op4_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of each query row. Bad vectors, ties and repeated rows: see maxscore.quantised and top_k."""
    vectors = maxscore.quantised(read(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, vectors.where("key % 20 = 0"))


def op5_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses by words. Nulls, repeated ids and empty tables: see substrings.by_words."""
    found = substrings.by_words(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("n", "n_words").select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and its language. Null texts and empty tables: see langid.identify."""
    return langid.identify(read(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses by bytes. Nulls, repeated ids and empty tables: see substrings.by_bytes."""
    found = substrings.by_bytes(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("n", "n_bytes").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document, read back from its file. Nulls, repeated keys and empty tables: see huffman.write_corpus."""
    root = huffman.write_corpus(read(spark, sf_dir, "documents"), LIBRARY_FILE, PATTERN, end_id=2)
    return huffman.read_corpus(spark, root)


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page, read back from its archive. Nulls, equal payloads and empty tables: see warc.archive."""
    return warc.round_trip(spark, read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and its verdict. Null texts and sources, repeated rows: see quality.quality."""
    return quality.quality(read(spark, sf_dir, "documents")).drop("host")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's runs. Null texts, repeated keys and empty tables: see periodic.find_runs."""
    return periodic.digest(periodic.find_runs(periodic.with_tails(read(spark, sf_dir, "documents"))))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's article. Null and empty pages, repeated keys: see tagpaths.extract."""
    return tagpaths.extract(read(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's whitened components. Bad vectors, repeated rows and empty tables: see whitening.whiten."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_vector_packing": op2_vector_packing,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_maxscore_top_k": op4_maxscore_top_k,
    "op5_suffix_tree_dedup": op5_suffix_tree_dedup,
    "op6_language_id": op6_language_id,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_token_files": op8_token_files,
    "op9_warc_round_trip": op9_warc_round_trip,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_main_text": op12_main_text,
    "op13_whitening": op13_whitening,
    "conversation_packing": conversation_packing,
}

ORACLES = {
    "op3_ngram_jaccard": ngrams.ORACLE,
    "op4_maxscore_top_k": maxscore.ORACLE,
    "op5_suffix_tree_dedup": substrings.ORACLE_WORDS,
    "op7_suffix_array_dedup": substrings.ORACLE_BYTES,
    "op9_warc_round_trip": warc.ORACLE,
    "op10_quality_rules": quality.ORACLE,
    "op11_periodic_runs": periodic.ORACLE,
    "op12_main_text": tagpaths.ORACLE,
}
