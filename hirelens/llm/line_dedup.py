"""Line dedup: drop lines that several documents share (DataFrame functions only).

Lines are exploded, normalised and hashed; distinct documents are counted per
hash, and lines over the threshold go everywhere but in the largest doc_id that
holds them.  Only hashes are shuffled to find them; each text moves once, to
meet the (few) hashes it has to lose.

Cases: null or empty text is one empty line.  Rows that repeat a doc_id count as
one document and are each cleaned; rows without doc_id count together as one
document, smaller than all others.  An empty table gives an empty result.  Input
columns named as a result column are replaced; others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import ascii_lower, strip_spaces, with_columns_last

RESULT = ["n_lines", "n_dropped"]


def line_key(line: Column) -> Column:
    return ascii_lower(strip_spaces(line))


def _fingerprint(key: Column) -> Column:
    """128 bits, as two independent 64-bit hashes."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``(fp, __keeper)``: fingerprints of the lines to drop, and the doc_id in which they stay.

    The distinct count runs on (fingerprint, doc_id) first, so a line of a third
    of all documents reaches its final task as one partial count per task.
    """
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("__line"))
    keys = lines.select("doc_id", line_key(F.col("__line")).alias("__key")).where(F.length("__key") >= min_chars)
    seen = keys.select(_fingerprint(F.col("__key")).alias("__fp"), "doc_id").distinct()
    found = seen.groupBy("__fp").agg(F.count(F.lit(1)).alias("__n"), F.max("doc_id").alias("__keeper"))
    return found.where(F.col("__n") >= min_docs).select("__fp", "__keeper")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with cleaned texts, and n_lines (before) and n_dropped."""
    docs = with_columns_last(docs, RESULT)
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("__line"))
    keys = lines.select("doc_id", line_key(F.col("__line")).alias("__key")).where(F.length("__key") >= min_chars)
    seen = keys.select(_fingerprint(F.col("__key")).alias("__fp"), "doc_id").distinct()
    repeated = repeated_lines(docs, min_chars, min_docs)
    drops = (
        seen.join(repeated, "__fp")
        .where(~F.col("doc_id").eqNullSafe(F.col("__keeper")))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.collect_list("__fp").alias("__drops"))
    )
    split = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    kept = F.filter(split, lambda x: (F.char_length(line_key(x)) < min_chars)
                    | ~F.array_contains(F.col("__drops"), _fingerprint(line_key(x))))
    joined = docs.join(drops.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    some = joined.withColumn("__kept", F.when(F.col("__drops").isNotNull(), kept))
    n_lines = F.size(split).cast("long")
    return some.select(
        *[F.when(F.col("__kept").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join("__kept", "\n")).alias("text")
          if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        n_lines.alias("n_lines"),
        F.when(F.col("__kept").isNull(), F.lit(0).cast("long")).otherwise(n_lines - F.size("__kept")).alias("n_dropped"),
    )
