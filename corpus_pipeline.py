"""The corpus pipeline: five stages from raw documents to packed sequences.

Toxicity, near-duplicates, secrets, source weights, packing. Each stage works on all that the
one before it kept and is written as Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import mixing, ngram_join, packing, secrets, toxicity
from ledgerline.llm.common import materialise, read
from ledgerline.llm.queries import BYTE_TOKENIZER, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier predicts toxic go."""
    return toxicity.keep(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of linked documents the one with the smallest doc_id stays."""
    return ngram_join.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every document stays; the values of its secrets are replaced by a mark."""
    return secrets.redact(docs, secrets.train(docs))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each source near its target; repeats become rows, a cut keeps first words."""
    return mixing.take(docs)


def pack_best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the packed pieces."""
    return packing.pack_documents(docs, tokenizer(BYTE_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_each_group),
    ("secrets", hide_secrets),
    ("mixing", mix_to_weights),
    ("packing", pack_best_fit),
]

#: The classifier, the join and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
