"""Staged tables in the shared checkpoint folder (medallion hand-off points).

Silver is written once as Parquet and read back, which

* cuts the lineage (a lost executor recomputes from the table, not from raw text),
* stops the optimizer from substituting the large extraction expressions
  into downstream filters, and
* lets every gold / report scan prune to the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hirelens.session import SCRATCH, scratch_path


def stage_path(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir``; returns where."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and return the re-read table."""
    return df.sparkSession.read.parquet(stage_path(df, name, partition_by))


def drop_staged(spark) -> int:
    """Delete the scratch folders this process created (Hadoop FileSystem, so it works on the shared folder).

    Call it when the queries reading them have finished; returns how many were removed.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    removed = 0
    while SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed
