"""One query for each operator of this subpackage, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mergestone.llm import chat, decontaminate, extract, licenses, near_dup, pieces, quality, topk, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.resolve_revisits(warc.records_of_pages(_table(spark, sf_dir, "pages"))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.license_scan(_table(spark, sf_dir, "documents")))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(_table(spark, sf_dir, "conversations"))


def op8_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(_table(spark, sf_dir, "pages"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality.quality(documents, quality.train(documents))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_revisits": op2_revisits,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_license_scan": op6_license_scan,
    "op7_chat": op7_chat,
    "op8_extract": op8_extract,
    "op9_pieces": op9_pieces,
    "op10_quality": op10_quality,
}
ORACLE_SQL: dict[str, str] = {
    "op1_topk": topk.ORACLE_SQL,
    "op2_revisits": warc.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op5_near_duplicates": near_dup.ORACLE_SQL,
}
