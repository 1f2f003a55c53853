"""Corpus preparation: documents in, packed training pieces out.

Each stage calls one operator of ``estatelens.llm``, gets all that the stage
before it kept, and is written as Parquet and read again for the next.

Null and empty texts, and texts without a letter, have no language and go
with the first stage.  Of equal texts the row with the largest doc_id stays
(a null id loses), of near copies that with the smallest; rows that repeat
both id and text are one row after these stages.  Columns beside those of
``documents``, under whatever names, pass through every stage but the last.
Long texts are worked on whole.  Empty tables give an empty result; an empty
``benchmark`` contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelens.llm import decontaminate, exact_dedup, language, packing, simhash
from estatelens.llm.shared import cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language classifier does not reject."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents one with the smallest doc_id."""
    return simhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark contamination."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Neither the classifier nor the tokenizer can be written in SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to
    the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
