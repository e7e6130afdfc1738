"""Catalogue queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    ffd_packing,
    mixing,
    near_vectors,
    ngram_join,
    packing,
    passages,
    periodic_runs,
    quality,
    secrets,
    token_alignment,
    token_files,
    toxicity,
    url_rules,
)
from ledgerline.llm.common import read
from ledgerline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Tokenizer files of the queries; operators take a path.
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: write the ORC token files of all documents and read them back."""
    path = scratch_path(spark, "token-orc")
    token_files.write_tokens(read(spark, sf_dir, "documents"), path, tokenizer(WORD_TOKENIZER))
    stored = token_files.read_tokens(spark, path)
    rows = token_files.with_start(token_files.id_checksums(stored), stored)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: target, and words taken of each document."""
    mixed = mixing.mix(mixing.keyed(read(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: every piece with its sequence and offset."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer(BYTE_TOKENIZER))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: spans of secrets in every text."""
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: shingle count and component of every document."""
    return ngram_join.link(read(spark, sf_dir, "documents"))


def toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: score and prediction of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


#: Rules of the URL query (fixed by its contract): host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: statistics and verdict of every document."""
    return quality.judge(read(spark, sf_dir, "documents"))


def near_dup_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: links and component of every vector."""
    return near_vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a passage of over 50 words that another one repeats."""
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


def align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: groups and links of the byte-level and the piece tokens of every document."""
    return token_alignment.align_documents(read(spark, sf_dir, "documents"), tokenizer(BYTE_TOKENIZER), tokenizer(PIECE_TOKENIZER))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: periodic runs of every document, with the contract's loops put in."""
    return periodic_runs.run_digests(read(spark, sf_dir, "documents"), periodic_runs.looped)


def ffd_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: every piece with its sequence and offset."""
    return ffd_packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer(WORD_TOKENIZER))


LLM_CATALOGUE: dict[str, Query] = {
    "op1_token_orc": token_orc,
    "op2_secret_scan": secret_scan,
    "op3_ngram_jaccard_join": ngram_jaccard_join,
    "op4_toxicity": toxicity_score,
    "op5_mix_sources": mix_sources,
    "op6_url_filter": url_filter,
    "op7_vector_best_fit": pack_sequences,
    "op8_quality_rules": quality_rules,
    "op9_near_dup_vectors": near_dup_vectors,
    "op10_substring_dedup": repeated_passages,
    "op11_token_alignment": align_tokens,
    "op12_periodic_runs": word_runs,
    "op13_ffd_packing": ffd_pack,
}
