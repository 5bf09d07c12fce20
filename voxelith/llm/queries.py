"""The queries of the training-data operators, with production parameters, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, clustering, exact_dedup, importance, langid, media, minhash, mixing, quality, secrets, token_counts, token_output, toxicity
from .common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocation(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encoded(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "n_pieces", toxicity.spans().alias("offending"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.lloyd(table(spark, sf_dir, "embeddings")).drop("centroid")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_token_counts": op5_token_counts,
    "op6_minhash": op6_minhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_output": op8_token_output,
    "op9_media": op9_media,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_toxicity": op11_toxicity,
    "op12_importance": op12_importance,
    "op13_clustering": op13_clustering,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op13_clustering": clustering.sql(),
    "op7_exact_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM docs WINDOW w AS (PARTITION BY norm)
""",
}
