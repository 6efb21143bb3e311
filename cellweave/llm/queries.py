"""The corpus queries, one for each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import bpe, jaccard, langid, licenses, mixing, permutation, urlrules, vectors, warc, wordpiece
from .common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_all(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.piece_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": op1_license_scans,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_url_filters": op7_url_filters,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
}
ORACLE_SQL: dict[str, str] = {
    "op3_mixing": mixing.mixture_sql(),
    "op7_url_filters": urlrules.judge_sql(),
    "op10_warc": warc.ROUND_TRIP_SQL,
}
