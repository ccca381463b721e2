"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm.ann import nearest
from granero.llm.byte_bpe import decode, encode
from granero.llm.fill_middle import fill_in_middle, restored
from granero.llm.host_rules import MEASURES, host_quality
from granero.llm.licenses import labelled, notices, scan
from granero.llm.line_dedup import dedup_lines
from granero.llm.mixing import mix
from granero.llm.negatives import hard_negatives
from granero.llm.packing import pack_documents
from granero.llm.rule_ensemble import classify, fit_rules
from granero.llm.sharding import shard
from granero.llm.site_templates import extract
from granero.llm.tables import read
from granero.llm.weighted_minhash import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


@query
def op2_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = host_quality(read(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", *MEASURES, "base_failed", "kept", "host_rejected")


@query
def op3_weighted_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(scan(read(spark, sf_dir, "documents")))


@query
def op4_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices wherever their lines break; ``op4_license_scan`` is held to its SQL, which reads lines."""
    return labelled(notices(read(spark, sf_dir, "documents")))


@query
def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return classify(docs, fit_rules(docs, read(spark, sf_dir, "labels")))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_bounded_load_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


@query
def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op11_displacement_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = restored(fill_in_middle(read(spark, sf_dir, "documents")))
    return moved.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


@query
def op12_split_point_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = decode(encode(read(spark, sf_dir, "documents")))
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
