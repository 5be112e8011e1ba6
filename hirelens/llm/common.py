"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed: the white space of the contracts, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_OWN: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _OWN.setdefault("dir", tempfile.mkdtemp(prefix="llm-shared-"))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors don't matter."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII takes the fast built-in; other texts are translated."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def strip_spaces(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def with_columns_last(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns whose names (in any case) an operator is about to use for its results."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
