"""Corpus pipeline: from raw documents to packed training sequences.

Quality rules, SimHash near-duplicates, benchmark decontamination, pseudonyms
for personal data, best-fit packing. Each stage takes (spark, docs, sf_dir),
works on all documents its predecessor kept, and but for the last returns the
columns of ``documents``; its result is written as Parquet and read again.

In every stage an empty table gives an empty one, very long texts are worked on whole, and
columns beside doc_id and text pass through, whatever their names (the last stage leaves them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comptoir.llm import decontam, packing, pii, rules, simhash
from comptoir.llm._util import stage, table
from comptoir.llm.suite import CAPACITY, SIMHASH


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table. Null and empty texts fail; repeated
    rows and rows without an id are judged like others."""
    return rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id. Rows that repeat an id are
    one document; rows without an id stay; texts without a word are alike."""
    return simhash.keep_one(docs, **SIMHASH)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Rows without an id are judged by their own text; null and empty texts
    stay, and so does all if the benchmark is empty."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by pseudonyms. Null texts stay null; repeated rows are
    changed alike."""
    return pii.pseudonymise(docs, pii.key_of(spark), mark=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences, with their ids. Null texts are empty documents; repeated rows and
    rows without an id are packed like others."""
    return packing.pack_documents(docs, CAPACITY)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("best-fit packing", packed),
]

#: The stages are not expressible in SQL (fingerprints, edit distance, permutations, packing); see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
