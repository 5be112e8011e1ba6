"""Dumps as they land: files whose order decides which duplicate is first and which is last.

Spark rows have no order, but files do.  Their hidden columns (``_metadata``)
say when a file was written, its name, and where a row stands in it; they become
``_batch`` (which dump) and ``_seq`` (place within the dump), the columns that
``operators.merge`` orders by.  The result doesn't depend on the order in which
files are listed, read or scheduled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators.merge import BATCH, SEQ


def _folder(path):
    return F.regexp_replace(path, r"/[^/]*$", "")


def _plain(path):
    """Paths of the two listings agree but for escapes and the number of slashes after the scheme."""
    return F.regexp_replace(F.try_url_decode(path), r"^([a-z0-9]+:)/+", "$1/")


def read_dumps(spark: SparkSession, paths: list[str], schema: T.StructType, fmt: str = "csv", dump: str = "file",
               options: dict[str, str] | None = None) -> DataFrame:
    """Rows of all dumps with ``_batch`` and ``_seq``; ``paths`` may come in any order.

    ``dump="file"``: every file is a dump, ordered by its modification time, then
    its name.  ``dump="folder"``: the files of a folder are one dump, in the order
    of their names; folders are ordered by their newest file, then their name.

    Within a file, Parquet knows the row's index; for text formats it is the
    block's offset and the row's place among those of the block, which one task
    reads from front to back.
    """
    if dump not in ("file", "folder"):
        raise ValueError(f"dump must be 'file' or 'folder', not {dump!r}")
    reader = spark.read.schema(schema).options(**(options or {}))
    if fmt == "csv":
        reader = reader.options(**{"header": "true", "escape": '"', **(options or {})})
    rows = reader.format(fmt).load(paths)
    if fmt == "parquet":
        place = F.struct(F.col("_metadata.file_name").alias("name"), F.lit(0).cast("long").alias("block"), F.col("_metadata.row_index").alias("row"))
    else:
        place = F.struct(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
    if dump == "file":
        batch = F.struct(F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_name").alias("name"))
        return rows.select(*schema.names, batch.alias(BATCH), place.alias(SEQ))
    # The binary source lists files without reading them when their content isn't asked for.
    files = spark.read.format("binaryFile").load(paths).select(_plain(_folder(F.col("path"))).alias("_f"), "modificationTime")
    newest = files.groupBy("_f").agg(F.max("modificationTime").alias("_modified"))
    placed = rows.select(*schema.names, place.alias(SEQ), _plain(_folder(F.col("_metadata.file_path"))).alias("_folder"))
    joined = placed.join(newest, F.col("_folder") == F.col("_f"))
    batch = F.struct(F.col("_modified").alias("modified"), F.col("_folder").alias("name"))
    return joined.select(*schema.names, batch.alias(BATCH), SEQ)
