"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, exact_dedup, langid, line_dedup, ngram_join, packing, suffix_dedup, toxicity
from ._common import spread, table
from .bpe import bpe_round_trip
from .token_count import token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.language_id(docs, langid.fit(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name, in the order of their numbers."""
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can say; that of op9 is the exact search, which tables of one small block get too."""
    return {"op4_exact_dedup": exact_dedup.ORACLE, "op6_ngram_join": ngram_join.ORACLE, "op8_suffix_dedup": suffix_dedup.ORACLE, "op9_ann": ann.ORACLE}
