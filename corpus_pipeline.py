"""A cleaned, deduplicated, tokenized corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the last
return the columns of ``documents``. Between stages the rows are written as Parquet to the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontam, lang_cnn, near_dups, pii, sp_codec
from tablewright.llm.common import read_table
from tablewright.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those that the network finds to be in no language of the corpus."""
    return lang_cnn.in_known_language(docs, lang_cnn.learn_known_languages(docs))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest doc_id."""
    return near_dups.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; drops no document."""
    return pii.mask(docs, pii.learn(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, text, ids, n_ids, ids_crc32, round_trip): the piece ids, and whether they decode to the text."""
    return sp_codec.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), "doc_id", "text")


STAGES = [
    ("language ID", known_language),
    ("near-dedup", near_deduplicated),
    ("decontamination", decontaminated),
    ("PII", without_personal_data),
    ("SentencePiece", encoded),
]

#: SQL cannot express the networks of the first and the fourth stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
