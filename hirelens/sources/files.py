"""CSV / Parquet / JSON sources and sinks with explicit schemas."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import refdata as R
from hirelens.functions.text import join_list

BRONZE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("date_posted", T.StringType()),
    T.StructField("work_type", T.StringType()),
    T.StructField("employment_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("header_text", T.StringType()),
])


# Line breaks inside a splittable CSV cell, and the backslash that marks them.
_LINE_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]
_ASIDE = "\u0001"


def _one_line(c: Column) -> Column:
    for plain, escaped in _LINE_ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def _many_lines(c: Column) -> Column:
    c = F.replace(c, F.lit("\\\\"), F.lit(_ASIDE))
    for plain, escaped in _LINE_ESCAPES[1:]:
        c = F.replace(c, F.lit(escaped), F.lit(plain))
    return F.replace(c, F.lit(_ASIDE), F.lit("\\"))


def read_bronze_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = BRONZE_SCHEMA, splittable: bool = False) -> DataFrame:
    """RFC-4180 CSV with header; bad dates → null.

    By default a quoted field may go over several lines, as the dumps have them;
    such a file can't be cut, so each file is one task.  ``splittable`` files
    (written so by :func:`write_csv`) have one record per line, with line breaks
    as escapes, and are read in splits.
    """
    reader = (spark.read.schema(schema).option("header", True).option("multiLine", not splittable).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("mode", "PERMISSIVE"))
    df = reader.csv(path)
    if splittable:
        df = df.select(*[_many_lines(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    if "date_posted" in df.columns and dict(df.dtypes)["date_posted"] == "string":
        df = df.withColumn("date_posted", F.try_to_date("date_posted"))
    return df


def write_csv(df: DataFrame, path: str, array_sep: str = ";", splittable: bool = False) -> None:
    """CSV sink; array columns become ``;``-joined strings (K4); ``splittable`` as :func:`read_bronze_csv` says.

    An empty string is written quoted and comes back empty, null is written bare and comes back null.
    """
    def cell(c: str, t: str) -> Column:
        v = join_list(c, array_sep) if t.startswith("array") else F.col(c)
        return (_one_line(v) if splittable and (t == "string" or t.startswith("array")) else v).alias(c)

    out = df.select(*[cell(c, t) for c, t in df.dtypes])
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite.  Never target a path the plan is reading; use ``replace_parquet``."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def replace_parquet(df: DataFrame, path: str) -> DataFrame:
    """S4 for read-change-rewrite: ``df``, which may read ``path``, takes its place.

    The new files are written beside the old ones; then the old folder is renamed
    away, the new one takes its name, and only then the old one is deleted.  A
    failure before the renames leaves the old table, one between them leaves both
    tables whole under ``<path>.old`` and ``<path>.new``.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at(f"{path}.old"), True)
    if fs.exists(at(path)) and not fs.rename(at(path), at(f"{path}.old")):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(at(f"{path}.new"), at(path)):
        raise OSError(f"could not move {path}.new into place; the former table is at {path}.old")
    fs.delete(at(f"{path}.old"), True)
    return spark.read.parquet(path)


def read_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """JSON object ``{code: units per USD}`` → (code, rate); USD=1 added; USD alone, with a warning, if there is no such file.

    The file is one small object (≤ ~200 ISO codes).  Without a path the
    package's own rates are read on the driver, whose folder executors don't see.
    """
    if path is None:
        return spark.createDataFrame(sorted(({**R.synthetic_rates(), "USD": 1.0}).items()), "code string, rate double")
    try:
        raw = spark.read.option("multiLine", True).text(path, wholetext=True)
        m = raw.select(F.from_json("value", "map<string,double>").alias("m"))
        rates = m.select(F.explode("m").alias("code", "rate")).where(F.col("code") != "USD")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        logging.getLogger(__name__).warning("no rates at %s: all currencies but USD stay without a rate", path)
        rates = spark.createDataFrame([], "code string, rate double")
    usd = spark.createDataFrame([("USD", 1.0)], "code string, rate double")
    return rates.unionByName(usd)
