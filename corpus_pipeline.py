"""Corpus preparation: from documents to packed token sequences.

Each stage works on all rows its predecessor kept, is written as Parquet in the
shared folder and read again by the next one:

1. toxicity: rows that the positive-unlabelled model rejects go,
2. near duplicates: of each group of linked texts (five-word shingles, Jaccard
   similarity of 0.8 or more) the row with the least id stays,
3. decontamination: rows that contain a benchmark item go,
4. secrets: spans are masked in the text, no row goes,
5. packing: the texts become pieces of token sequences.

All but the last return the columns of ``documents``.  The stages take null and
empty texts, repeated rows and empty tables as their operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterline.llm import decontamination, jaccard_join, secrets, toxicity
from rosterline.llm.common import read_table, written
from rosterline.llm.queries import pack_publicly


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_publicly(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# The learned model and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
