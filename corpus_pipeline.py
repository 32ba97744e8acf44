"""The corpus pipeline: five stages, each over all that the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it
as Parquet in the shared folder and reads it again for the next stage, so a
lost executor never costs more than the tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.llm import decontaminate, near_dup, pieces, quality, toxicity
from mergestone.llm.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer rejects go."""
    return quality.only_good(docs, quality.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the smallest id stays."""
    return near_dup.one_of_each(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as piece ids; these decode to the text again."""
    return pieces.encode(docs).select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encode", encode),
]
#: Models and near-duplicate components can't be said in SQL; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; (doc_id, ids, n_pieces) of the documents that stay."""
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.save(name, stage(spark, docs, sf_dir))
        if last:
            scratch.drop(last)
        last = name
    return docs
