"""From raw documents to packed training sequences.

Four stages, each written as Parquet in the shared folder and read back as
the next one's documents (the last writes its pieces itself): the quality classifier, the quality rules,
near-duplicate removal and packing.  All but the last return the columns of
``documents``, with whatever other columns came along, unchanged.

Defined results: a null text is empty, too short for the rules, and goes there;
a null language is judged under the model of all text; rows with a null doc_id
are unlabelled, and of a class of near-duplicates they stay only if none has an
id; repeated rows are near-duplicates, one stays; among equal ids the first row
stays; without trusted labels the classifier keeps everything; a text of any
length is read and packed whole; an empty table gives no rows; columns may have
any names, those of the operators included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changefeed.llm import bagminhash, kneser, packing, rules
from changefeed.llm.common import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return kneser.keep(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    return rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bagminhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their ids."""
    return saved(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")), "packed")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("packing", packed),
]

#: The classifier and the signatures are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
