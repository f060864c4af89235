"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes what its predecessor kept, written as parquet and read again,
and gives documents with the same columns; the last gives the packed pieces.

1. toxicity: documents that the nearest labelled examples call toxic go.
2. quality_rules: documents that fail the base rules or their group's cutoffs go.
3. exact_dedup: of texts equal but for white space the longest stays.
4. near_dedup: of documents whose SimHash fingerprints are linked one stays.
5. packing: the rest is encoded and packed into sequences of at most 4096 ids.

Null texts count as empty, which fails the quality rules. A stage that is given
an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import adaptive_rules, digest_index, packing, simhash, toxicity
from millrace.llm.common import documents, load, stage
from millrace.llm.queries import WORD_BPE, tokenizer


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.civil_rows(docs, load(spark, sf_dir, "labels"))


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return adaptive_rules.good_rows(docs)


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_index.distinct(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer(WORD_BPE), end_id=1, capacity=4096)


STAGES = [
    ("toxicity", _toxicity),
    ("quality_rules", _quality_rules),
    ("exact_dedup", _exact_dedup),
    ("near_dedup", _near_dedup),
    ("packing", _packing),
]

#: SQL has no TF-IDF neighbours, XXH64 fingerprints or tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return stage(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
