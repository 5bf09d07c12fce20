"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and reread as the
next stage's docs. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelith.llm import bpe_codec, common, exact_dedup, minhash, mixing, quality


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts go; a null language, or one of few trusted documents, is judged by all languages together;
    repeated rows are judged alike; an empty table stays empty. All columns stay, whatever they are called.
    """
    return quality.keep(docs, common.table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id stays.

    Null counts as an empty text, a null doc_id as the largest; of rows that repeat a doc_id and a text one stays; an
    empty table stays empty. All columns stay, whatever they are called.
    """
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies (five-word shingles, similarity 0.8 or more), the one with the smallest doc_id stays.

    Null and empty texts and rows without doc_id are copies of nothing and stay; rows that repeat a doc_id count as one
    document and stay or go together; an empty table stays empty. All columns stay, whatever they are called.
    """
    return minhash.dedup(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights: a document comes as often as the mix takes it, up to three times.

    A null source is one of the sources, the last; null and empty texts have no words and come as often as their source
    does where their turn is; of a source without words none comes; rows that repeat a doc_id and a size come equally
    often; an empty table stays empty. All columns stay, whatever they are called.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that comes out of the mix, with their count and digests.

    Null and empty texts have no ids; repeated rows and null doc_ids are encoded like any other; an empty table gives
    an empty result. Other columns are not read.
    """
    return bpe_codec.encoded(docs, with_ids=True)


STAGES = [
    ("quality_filter", filter_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: The quality model and the near-copy groups have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each result written to the shared folder and reread; what a stage stored for itself goes."""
    scratch = common.Scratch(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        with common.released():
            after = scratch.store(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.free(before)
        docs = before = after
    return docs
