"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import (
    audit, collocations, credentials, fingerprints, licenses, mixing, neardup, oracle, packing, pii, quality, tokens, urls, warc,
)

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_cascade", sql=oracle.QUALITY)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query("op2_personal_data", sql=oracle.PERSONAL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secret_report(table(spark, sf_dir, "documents"))


@query("op5_source_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op7_order_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op8_near_duplicates", sql=oracle.NEAR)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_sequence_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_MODEL)


@query("op10_url_filter", sql=oracle.URLS)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op11_warc_round_trip", sql=oracle.ARCHIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op12_collocations", sql=oracle.COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_filter_audit", sql=oracle.AUDIT)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
