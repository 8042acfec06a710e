"""The registered queries of the text operators, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chunking, ctw, importance, mixing, partenum, pii, quality, repeats, secrets, tiling, toxicity, warc,
               whitening)
from .common import table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op7_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.compare_with_next(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(pii.find_personal_data(table(spark, sf_dir, "documents")), pii.KINDS)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as a long: null where the exact number has more than 63 bits."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


QUERIES = {f.__name__: f for f in (op1_warc_revisits, op2_secret_scan, op3_quality, op4_jaccard_join, op5_mix_sources, op6_context_tree,
                                   op7_chunk_fingerprints, op8_decontamination, op9_toxicity, op10_personal_data,
                                   op11_importance_resampling, op12_repeated_substrings, op13_embedding_whitening)}

ORACLE_SQL = {
    "op1_warc_revisits": warc.ORACLE_WARC,
    "op4_jaccard_join": partenum.ORACLE_COMPONENTS,
    "op5_mix_sources": mixing.ORACLE_MIX,
    "op11_importance_resampling": importance.ORACLE_RESAMPLE,
}
