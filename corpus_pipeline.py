"""A training-text pipeline over `documents`: each stage works on all that the one before has kept.

Toxic documents go, one document of each group of near duplicates stays, documents with passages of
benchmark items go, secrets are masked, and what is left is encoded into token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import bpe, decontaminate, near_duplicates, secrets, toxicity
from featureflow.llm.common import fresh, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled documents, does not call toxic.

    A null or empty text has the score of no evidence, the share of toxic labels, and stays while that is
    below one half. Repeated rows and rows of one text fare alike. Without toxic labels all stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_toxicity")
    scored = toxicity.score(docs, model, column=score)
    return scored.where(F.col(score) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, ids before null.

    Documents without words (null, empty, only signs) are no copies of one another; of such rows under one id
    the one whose text comes first stays, and so does one of rows that share id and words.
    """
    return near_duplicates.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item; null and empty texts stay, repeated rows too."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mask; n_chars follows the text where it changed.

    Null and empty texts stay as they are, a row without secrets keeps all its values.
    """
    spans = fresh(docs, "_secrets")
    found = secrets.find(docs, column=spans)
    masked = found.withColumn("text", secrets.masked(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        masked = masked.withColumn("n_chars", n_chars)
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids in place of its text, their number, and digests of ids and decoded text.

    A null or empty text has no ids. Columns that bear the name of a new one are replaced.
    """
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode_with_digests(docs, vocabulary).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]

#: No SQL: the classifier, the sketches and the encoder are beyond it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stage's rows written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
