"""Exact dedup by a persistent digest index.

The index is a table (digest, keep_id), bucketed and sorted by digest, at a path
of the shared storage; it outlives the session and is attached again by its path.
New data is digested, grouped by digest, and deduplicated by a sort-merge
anti-join with the index: only the batch is shuffled, the index is read bucket by
bucket as it lies.  What is left is appended, again bucketed and sorted.  An
append is one job whose files appear only when it commits, and a batch that is
added twice adds nothing, so a lost executor or driver means running it again.

No task holds a group of copies.  A batch meets the index as one row per digest,
after partial aggregation; decisions go back to the rows by digest and salt, and
there is one row per digest and salt on the other side, so a group of a third of
all rows is spread over as many tasks as there are salts.

Texts are equal if they agree after replacing each run of white space by one
space, by their SHA-256 digests.

Cases: null text counts as empty, and empty texts equal each other.  Among equal
texts a document without doc_id comes after all others and is kept only where
none of the group has one (then all such rows are that document).  Rows that
repeat doc_id and text are one document: they count in group_size and share its
decision.  An empty table adds nothing and gives an empty result.  Only doc_id
and text are read by ``exact_dedup``; ``new_documents`` passes all columns on,
and columns that begin with two underscores are its own.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import cut, parallelism, shared_dir

#: White space that is not a single space already.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space (32 bytes)."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " "), 256))


class DigestIndex:
    """Digests of the documents seen so far, with the doc_id that stays for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        """Attach the index at ``path``; make an empty one if there is none.

        ``buckets`` is fixed when the index is made (an index of 100 TB of texts
        wants some thousands); later it is read from beside the index.
        """
        self.spark, self.path = spark, path
        try:
            spec = spark.read.parquet(f"{path}.spec").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            spec = None
        if spec is None:
            spec = (buckets or parallelism(spark), id_type)
            spark.createDataFrame([spec], "buckets int, id_type string").write.mode("overwrite").parquet(f"{path}.spec")
        self.buckets, self.id_type = spec[0], spec[1]
        self.name = f"digest_index_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest, in a column ``digest``) that the index doesn't hold: a sort-merge anti-join."""
        return groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (digest, doc_id) that are new, each with its smallest doc_id."""
        # The joined key comes out of the aggregation, or the optimizer would join single rows and group after that.
        groups = rows.groupBy(F.col("digest").alias("by")).agg(
            F.any_value("digest").alias("digest"), F.min("doc_id").cast(self.id_type).alias("keep_id"))
        self.unseen(groups).select("digest", "keep_id").write.insertInto(self.name)

    def detach(self) -> None:
        """Forget the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def new_documents(index: DigestIndex, docs: DataFrame) -> DataFrame:
    """The documents of a batch that stay (whole rows), after adding the batch to ``index``.

    Earlier batches win; within the batch the smallest doc_id of equal texts stays.
    """
    rows = docs.withColumn("__digest", digest(F.col("text")))
    index.add(cut(rows.select(F.col("__digest").alias("digest"), "doc_id"), "exact-batch"))
    held = index.table().select(F.col("digest").alias("__d"), F.col("keep_id").alias("__keep"))
    stays = rows.join(held, (F.col("__digest") == F.col("__d")) & F.col("doc_id").eqNullSafe(F.col("__keep")), "left_semi")
    return stays.drop("__digest")


def _ranges(rows: DataFrame, batches: int) -> list[Column]:
    """Conditions that cut ``rows`` into ranges of doc_id, ascending; rows without one are in the last."""
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or isinstance(low, str):
        return [F.lit(True)]
    edges = [low + (high - low) * k // batches for k in range(1, batches)]
    at = F.col("doc_id")
    if not edges:
        return [F.lit(True)]
    middle = [(at >= a) & (at < b) for a, b in zip(edges, edges[1:])]
    return [at < edges[0], *middle, (at >= edges[-1]) | at.isNull()]


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batches: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256.

    ``docs`` goes into the index (a fresh one by default) in ``batches`` ranges of
    ascending doc_id, so what the index holds first has the smallest doc_id.
    group_size counts the rows of ``docs``.
    """
    spark = docs.sparkSession
    if index is None:
        kind = dict(docs.dtypes)["doc_id"]
        index = DigestIndex(spark, os.path.join(shared_dir(spark), f"digest-index-{uuid.uuid4().hex[:12]}"), id_type=kind)
    salts = parallelism(spark)
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    rows = cut(rows.withColumn("salt", (F.monotonically_increasing_id() % salts).cast("int")), "exact-digests")
    for part in _ranges(rows, batches):
        index.add(rows.where(part))
    salted = rows.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = salted.groupBy("digest").agg(F.sum("n").alias("group_size"))
    groups = sizes.join(index.table().hint("merge"), "digest")
    decided = salted.select("digest", "salt").join(groups, "digest")
    return rows.join(decided, ["digest", "salt"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
