"""A training corpus in five stages: toxic documents go, then repeats, near copies and repeated passages; the rest is packed.

Every stage takes the rows that the one before it kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import exact_dedup, ngram_join, packing, suffix_dedup, toxicity
from lexforge.llm._common import drop_table, finish, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from their labelled part, scores 0.7 or more go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest id stays; a null id is never dropped."""
    gone = ngram_join.ngram_join(docs).where("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def strip_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; n_chars follows the text. No document goes."""
    out = suffix_dedup.strip_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts and their places in sequences of 1024 tokens."""
    return packing.best_fit_pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_repeats),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", strip_passages),
    ("packing", pack),
]

#: SQL can't express the model, the packing and the passage stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, finish(lambda: stage(spark, docs, sf_dir))  # noqa: B023
        if k:
            drop_table(before)
    return STAGES[-1][1](spark, docs, sf_dir)
