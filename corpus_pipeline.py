"""From raw documents to packed training sequences, in five stages.

Each stage works on all documents that its predecessor kept, is written as Parquet to the
shared folder and read again by the next; all but the last give the columns of documents,
further columns included. Null doc_ids and repeated rows are rows like any other, and an empty
table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, language, packing, simhash, surrogates
from millrace.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: those without any letter, null and empty texts
    among them. A null ``lang`` is filled with the predicted language, where any was learned."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (3-word shingles, 2 bits) one document stays, the first by
    doc_id. Null and empty texts are copies of each other."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go. A null or empty text holds
    none; null or empty items have none."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to surrogates, the same for the same entity in all
    documents. Every row stays; a null or empty text stays as it is."""
    return surrogates.rewrite(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens. A null or empty text is the end token
    alone. Columns other than doc_id and text are not read."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]

#: Hash vectors, fingerprints, keyed surrogates and a tokenizer are beyond SQL; the tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
