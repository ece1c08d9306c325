"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Stages keep the columns of documents, and the last adds what it finds. A document goes only where a stage's
rule says so; clean documents pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise.llm import decontaminate, lines, mixing, near, quality
from letwise.session import scratch_path

SIMILARITY = 80
# of a source's pages: on sf0.1 lines of chance sentences reach 0.048, boilerplate begins at 0.086
LINE_RATIO = 0.05
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least its threshold)."""
    found = quality.classify(docs, _table(spark, sf_dir, "labels"))
    return found.where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars follows the text. Copies count as one
    page, so that the near-copy stage finds them whole and one of them stays."""
    found = lines.drop_boilerplate(docs, ratio=LINE_RATIO, copies_once=True).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return near.drop_near_copies(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, without hit spans of a window or more; n_chars follows the text."""
    found = decontaminate.remove_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with tokens, posteriors and the mixing rate. The rate is a weight of an evidence class and may
    be 0; no document is dropped for the class it is in."""
    return mixing.mix_documents(docs, _table(spark, sf_dir, "labels"))


STAGES = [("quality classifier", quality_filter), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing_rates)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each through a table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
