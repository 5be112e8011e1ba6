"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from hirelens.llm.common import read_table, shared_dir


def _columns(docs: DataFrame) -> list:
    """The columns of ``docs``; n_chars follows a changed text."""
    return [F.char_length("__text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("__text").alias("text") if c == "text"
            else F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    kept = docs.withColumns({"__doc": F.struct(*[F.col(f"`{c}`") for c in docs.columns])}).select("doc_id", "text", "__doc")
    scored = toxicity.score_toxicity(kept, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("__doc.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others share."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    cleaned = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct(*rest).alias("__rest")))
    return cleaned.select(F.col("text").alias("__text"), "__rest.*").select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"), size=5, percent=80)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words the mix takes of each."""
    return mixing.mix_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The classifier and the register bands are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    at = os.path.join(shared_dir(spark), f"pipeline-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs
