"""From raw documents to packed sequences, in five stages.

Each stage reads what the one before wrote. All but the last return the columns of
``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm.line_dedup import without_repeats
from granero.llm.mixing import mixed_documents
from granero.llm.packing import pack_documents
from granero.llm.rule_ensemble import accepted, fit_rules
from granero.llm.tables import read
from granero.llm.weighted_minhash import one_per_class
from granero.sources.staging import stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that have changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return accepted(docs, fit_rules(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; no document goes."""
    return _counted(without_repeats(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return one_per_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets."""
    return pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing),
]

# The classifier, the samples of near duplicates and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
