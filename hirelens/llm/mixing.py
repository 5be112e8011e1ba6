"""Mixing sources to target weights (DataFrame functions only).

Every row gets a hash-random key.  Within a source, rows are dealt by ranges of
that key into buckets of a bounded number of rows (a hot source has more
buckets), token counts are summed per bucket, prefix sums over buckets give each
bucket its offset, and a running sum inside each bucket gives each row its place.
A source's budget is then cut exactly: whole epochs first, the rest by place; the
row on which the cut falls gives only its words up to the cut.

Cases: null text has size 0 and is never taken; a null source is a source of its
own, last in order; rows that repeat are separate rows (equal rows are
interchangeable); empty sources and empty tables give targets of 0 or no rows.
Input columns named as a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import cut, strip_spaces, with_columns_last

WEIGHTS = (5, 2, 1)
RESULT = ["size", "source_size", "target", "taken"]
#: Hex digits of the key that choose the bucket: 13 digits are exact in a double.
KEY_DIGITS = 13


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text."""
    t = strip_spaces(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.lit(0).cast("long")).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+")).cast("long"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of ``sources`` (__source, __size): one row per source.

    Sources sorted by cap over weight reach their caps in that order, so which
    ones are capped follows from prefix sums, without iterating.
    """
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("__w", w.cast("double")).withColumn("__cap", F.col("__size") * F.lit(float(most)))
    order = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("__source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("__all", F.sum("__size").over(everything) * F.lit(float(share))).withColumn("__all_w", F.sum("__w").over(everything))
    s = s.withColumn("__left", F.col("__all") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
    s = s.withColumn("__left_w", F.col("__all_w") - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    s = s.withColumn("__capped", F.col("__left") * F.col("__w") > F.col("__cap") * F.col("__left_w"))
    s = s.withColumn("__rest", F.col("__all") - F.coalesce(F.sum(F.when(F.col("__capped"), F.col("__cap"))).over(everything), F.lit(0.0)))
    s = s.withColumn("__rest_w", F.col("__all_w") - F.coalesce(F.sum(F.when(F.col("__capped"), F.col("__w"))).over(everything), F.lit(0.0)))
    return s.withColumn("__target", F.when(F.col("__capped"), F.col("__cap")).otherwise(F.col("__w") * F.col("__rest") / F.col("__rest_w")))


def document_key(*more: Column) -> Column:
    """The hash-random key of a row, by doc_id and text (and ``more``)."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")), *more))


def mix_documents(docs: DataFrame, **how: object) -> DataFrame:
    """``docs`` with all its columns, and size, source_size, target and taken.

    Rows are placed without their texts (``mix_sources`` over narrow rows); then
    the result joins the texts, which move once.  Rows that agree in doc_id, text
    and source are interchangeable: each such group has at most three different
    values of taken, and its rows share them out by number.
    """
    names = with_columns_last(docs, RESULT).columns
    tag = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    narrow = docs.select("doc_id", "text", "source", document_key(tag).alias("__k"))
    placed = mix_sources(narrow, carry=["__k"], **how)
    values = placed.groupBy("__k", "taken").agg(F.count(F.lit(1)).alias("__c"), *[F.any_value(c).alias(c) for c in RESULT[:3]])
    shares = values.groupBy(F.col("__k").alias("__of")).agg(
        F.array_sort(F.collect_list(F.struct("taken", "__c"))).alias("__shares"), *[F.any_value(c).alias(c) for c in RESULT[:3]])
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], document_key(tag).alias("__k"))
    # The join's own partitioning and order serve the numbering, too.
    number = F.row_number().over(Window.partitionBy("__k").orderBy("__k"))
    joined = keyed.withColumn("__i", number).join(shares.hint("merge"), F.col("__k") == F.col("__of"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("taken"))

    def share(acc: Column, x: Column) -> Column:
        here = (F.col("__i") > acc["seen"]) & (F.col("__i") <= acc["seen"] + x["__c"])
        return F.struct((acc["seen"] + x["__c"]).alias("seen"), F.when(here, x["taken"]).otherwise(acc["taken"]).alias("taken"))

    taken = F.when(F.size("__shares") == 1, F.get("__shares", F.lit(0))["taken"]).otherwise(F.aggregate("__shares", start, share)["taken"])
    return joined.select(*[F.col(f"`{c}`") for c in names], *RESULT[:3], taken.alias("taken"))


def mix_sources(docs: DataFrame, carry: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                most: float = 2.0, bucket_rows: int = 2000) -> DataFrame:
    """``docs`` (or its columns ``carry``) with size, source_size, target and taken."""
    kept = with_columns_last(docs, RESULT)
    names = [c for c in (carry or kept.columns) if c in kept.columns]
    key = document_key()
    rows = cut(kept.select(*[F.col(f"`{c}`") for c in names], F.col("source").alias("__source"), F.col("doc_id").alias("__id"),
                           n_words(F.col("text")).alias("size"), key.alias("__key")), "mixing-rows")
    sources = rows.groupBy("__source").agg(F.sum("size").alias("__size"), F.count(F.lit(1)).alias("__rows"))
    targets = source_targets(sources, weights, share, most).select(
        F.col("__source").alias("__s"), F.col("__size").alias("source_size"), F.col("__target").alias("target"),
        F.ceil(F.col("__rows") / F.lit(bucket_rows)).alias("__buckets"))
    spot = F.conv(F.substring("__key", 1, KEY_DIGITS), 16, 10).cast("double") / F.lit(float(16**KEY_DIGITS))
    dealt = rows.join(targets, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s").withColumn("__bucket", F.floor(spot * F.col("__buckets")))

    # Bucket offsets in two levels: no window holds more than the square root of a source's buckets at 100 TB.
    sums = dealt.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum")).withColumn("__block", F.floor(F.col("__bucket") / 1000))
    blocks = sums.groupBy("__source", "__block").agg(F.sum("__sum").alias("__sum"))
    earlier = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(F.col("__source").alias("__bs"), F.col("__block").alias("__bb"), F.coalesce(
        F.sum("__sum").over(Window.partitionBy("__source").orderBy("__block").rowsBetween(*earlier)), zero).alias("__block_start"))
    sums = sums.withColumn("__in_block", F.coalesce(
        F.sum("__sum").over(Window.partitionBy("__source", "__block").orderBy("__bucket").rowsBetween(*earlier)), zero))
    offsets = sums.join(blocks, F.col("__source").eqNullSafe(F.col("__bs")) & (F.col("__block") == F.col("__bb"))).select(
        F.col("__source").alias("__os"), F.col("__bucket").alias("__ob"), (F.col("__block_start") + F.col("__in_block")).alias("__offset"))
    placed = dealt.join(offsets, F.col("__source").eqNullSafe(F.col("__os")) & (F.col("__bucket") == F.col("__ob")))
    inside = Window.partitionBy("__source", "__bucket").orderBy("__key", "__id", "size").rowsBetween(*earlier)
    start = F.col("__offset") + F.coalesce(F.sum("size").over(inside), zero)

    budget = F.floor(F.col("target") + 0.5)
    placed = placed.withColumn("__start", start).withColumn("__budget", budget)
    placed = placed.withColumn("__epochs", F.when(F.col("source_size") > 0, F.floor(F.col("__budget") / F.col("source_size"))).otherwise(zero))
    last = F.greatest(zero, F.least(F.col("size"), F.col("__budget") - F.col("__epochs") * F.col("source_size") - F.col("__start")))
    return placed.select(*[F.col(f"`{c}`") for c in names], "size", "source_size", "target", (F.col("__epochs") * F.col("size") + last).alias("taken"))
