"""A training corpus from raw documents: each stage is one of the operators.

toxicity -> SimHash near-dedup -> benchmark decontamination -> PII surrogates
-> SentencePiece encoding.  Every stage takes (spark, docs, sf_dir) and returns
a frame that is written as Parquet and reread as the next one's docs; all but
the last keep the columns of documents.  Null and empty texts pass the
filters; empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm import decontam, pieces, pii, simhash, toxicity
from stagewise.llm.common import shared_dir, ship

#: No SQL expresses the toxicity model, the surrogates or the encoding.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't predict toxic, each judged by its text alone: repeated
    ids and rows, null and empty texts are rows like any other, and other columns aren't read."""
    ship(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate texts one document, the one with the smallest id; see ``simhash.keep_one``.

    Rows that share an id but not their texts are different documents and both
    stay; of rows alike in every column one stays; rows without an id stay if no
    row of their group has one, one of each group.
    """
    ship(spark)
    return simhash.keep_one(docs, shingle=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item, each row judged by its text alone; null and empty
    texts stay, items with a null id count, other columns aren't read."""
    ship(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the detected entities and n_chars of the new text; an entity has one
    surrogate in all rows, repeated ids or not, null texts stay null."""
    ship(spark)
    out = pii.anonymise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip) of all documents, a row each; null texts have no ids."""
    ship(spark)
    return pieces.encode(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("decontamination", drop_contaminated), ("pii", replace_pii), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

